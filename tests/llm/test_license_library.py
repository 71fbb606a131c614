"""The library's notices as they are usually worded, and each license against its namesakes."""

import pytest

from cartstream.llm.licenses import TEMPLATES, license_scan
from cartstream.llm.queries import op8_license_scan

from .conftest import docs_frame

GNU = (
    "This {} is free software: you can redistribute it and/or modify it under the terms of the "
    "GNU {} as published by the Free Software Foundation, either version {} of the License"
)

NOTICES = {
    "Copyright 2020 Example Ltd. All rights reserved. More text": "all-rights-reserved",
    GNU.format("program", "General Public License", "3") + ", or (at your option) any later version.": "gpl-3.0",
    "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a "
    "copy of the MPL was not distributed with this file": "mpl-2.0",
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or "
    "without fee is hereby granted, provided that": "isc",
    "This project is licensed under the MIT License, see LICENSE": "mit",
}


@pytest.mark.parametrize("before", range(4))
def test_usual_notices_are_reported(llm_spark, before):
    rows = [(i, "filler " * before + notice) for i, notice in enumerate(NOTICES)]
    result = {r.doc_id: r.licenses.split(",") for r in license_scan(docs_frame(llm_spark, rows)).collect()}
    for i, name in enumerate(NOTICES.values()):
        assert name in result[i]


NAMESAKES = {
    "Licensed under CC BY 4.0.": "cc-by-4.0",
    "Licensed under CC BY-NC 4.0.": "cc-by-nc-4.0",
    "Licensed under CC BY-SA 4.0.": "cc-by-sa-4.0",
    "Licensed under CC BY-NC-SA 4.0.": "cc-by-nc-sa-4.0",
    "Licensed under CC BY-ND 4.0.": "cc-by-nd-4.0",
    "Licensed under CC BY 3.0.": "cc-by-3.0",
    "Licensed under CC BY-NC-ND 2.5.": "cc-by-nc-nd-2.5",
    "Licensed under CC BY 5.0.": "",
    "SPDX-License-Identifier: MIT": "mit",
    "SPDX-License-Identifier: Apache-2.0": "apache-2.0",
    "SPDX-License-Identifier: GPL-2.0-or-later": "gpl-2.0",
    "SPDX-License-Identifier: GPL-3.0-only": "gpl-3.0",
    "SPDX-License-Identifier: LGPL-2.1-only": "lgpl-2.1",
    "SPDX-License-Identifier: AGPL-3.0-only": "agpl-3.0",
    "SPDX-License-Identifier: CC-BY-SA-4.0": "cc-by-sa-4.0",
    "SPDX-License-Identifier: EPL-2.0": "epl-2.0",
    "SPDX-License-Identifier: BSD-3-Clause": "bsd-3-clause",
    "SPDX-License-Identifier: BSD-2-Clause": "bsd-2-clause",
    "the GNU General Public License v3.0": "gpl-3.0",
    "under GNU GPL version 3": "gpl-3.0",
    "under GNU GPL version 2": "gpl-2.0",
    "Apache License Version 2.0, January 2004": "apache-2.0",
    "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007": "agpl-3.0",
    "the Eclipse Public License - v 2.0": "epl-2.0",
    "CC0 1.0 Universal": "cc0-1.0",
    "the European Union Public Licence v. 1.2": "eupl-1.2",
    "BSD-3-Clause": "bsd-3-clause",
    "the 2-Clause BSD License": "bsd-2-clause",
    "This work is licensed under a Creative Commons Attribution 4.0 International License.": "cc-by-4.0",
    "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International "
    "License.": "cc-by-nc-4.0",
    "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 "
    "International License.": "cc-by-nc-sa-4.0",
    "This work is licensed under the GNU General Public License, version 3.": "gpl-3.0",
    "This work is licensed under the GNU General Public License, version 2.": "gpl-2.0",
    "This work is licensed under the GNU Affero General Public License, version 3.": "agpl-3.0",
    "This work is licensed under the GNU Lesser General Public License, version 3.": "lgpl-3.0",
    "This work is licensed under the GNU General Public License, version 1.": "",
    GNU.format("program", "General Public License", "2"): "gpl-2.0",
    GNU.format("program", "General Public License", "3"): "gpl-3.0",
    GNU.format("library", "Lesser General Public License", "2.1"): "lgpl-2.1",
    GNU.format("library", "Lesser General Public License", "3"): "lgpl-3.0",
    GNU.format("program", "Affero General Public License", "3"): "agpl-3.0",
    "Licensed under the Apache License, Version 1.1.": "",
    "Distributed under the Boost Software License, Version 1.0.": "bsl-1.0",
}


@pytest.fixture(scope="module")
def namesakes(llm_spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("namesakes"))
    rows = [
        (100 * before + i, "filler " * before + text + " and more text")
        for before in range(4)
        for i, text in enumerate(NAMESAKES)
    ]
    docs_frame(llm_spark, rows).write.parquet(f"{folder}/documents.parquet")
    return {r.doc_id: r.licenses for r in op8_license_scan(llm_spark, folder).collect()}


@pytest.mark.parametrize("text", NAMESAKES)
def test_no_license_is_taken_for_its_namesake(namesakes, text):
    i = list(NAMESAKES).index(text)
    assert {namesakes[100 * before + i] for before in range(4)} == {NAMESAKES[text]}


# Whole texts, as they stand in files.
MIT = """MIT License

Copyright (c) 2020 Example

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT."""

BSD_2 = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution."""

BSD_3 = (
    BSD_2
    + """

3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission."""
)

ZLIB = """This software is provided 'as-is', without any express or implied warranty. In no
event will the authors be held liable for any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial
applications, and to alter it and redistribute it freely, subject to the following restrictions:"""

APACHE = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this
file except in compliance with the License. You may obtain a copy of the License at
http://www.apache.org/licenses/LICENSE-2.0. Unless required by applicable law or agreed to in
writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT
WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."""

TEXTS = [(MIT, "mit"), (BSD_2, "bsd-2-clause"), (BSD_3, "bsd-3-clause"), (ZLIB, "zlib"), (APACHE, "apache-2.0")]


def test_whole_texts_have_one_name(llm_spark):
    rows = [(10 * i + at, "word " * at + text) for i, (text, _) in enumerate(TEXTS) for at in range(10)]
    rows.append((900, "Permission is hereby asked, free of charge, for a person with a copy of this book"))
    result = {r.doc_id: r.licenses for r in license_scan(docs_frame(llm_spark, rows)).collect()}
    assert result.pop(900) == ""
    assert result == {10 * i + at: name for i, (_, name) in enumerate(TEXTS) for at in range(10)}


def test_every_template_holds_what_it_needs(llm_spark):
    rows = [(i, "a b c " + t.text + " d e f") for i, t in enumerate(TEMPLATES)]
    result = {r.doc_id: r.licenses for r in license_scan(docs_frame(llm_spark, rows)).collect()}
    assert result == {i: t.name for i, t in enumerate(TEMPLATES)}
