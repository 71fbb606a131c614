"""Token ids of many texts at once, by the `tokenizers` and `sentencepiece` libraries."""

from __future__ import annotations

import hashlib
import os
import string
from functools import cache

import numpy as np
import pyarrow as pa

from cartstream.llm.text import SPACE, binary_array, text_bytes

# Token ids of pieces of text that a worker keeps, and their number. When either
# is reached the worker starts afresh.
CACHED_PIECES = 500_000
CACHED_IDS = 4_000_000

# Pieces that are handed to the library as one text.
TOGETHER = 50_000


LETTER = np.zeros(256, bool)
LETTER[list(string.ascii_letters.encode())] = True
MARK = np.zeros(256, bool)
MARK[list(string.punctuation.replace("'", "").encode())] = True


def vocabulary(name: str) -> str:
    """The file's place on this machine: `name` is a path that all machines have, or
    the name of a file of the installed public tokenizers."""
    if os.path.exists(name):
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


def tokenizer_version(path: str) -> str:
    """Digest of the vocabulary file: another file never meets this one's counts."""
    with open(vocabulary(path), "rb") as file:
        return hashlib.sha256(file.read()).hexdigest()


def _solid(data: np.ndarray) -> np.ndarray:
    """Bytes that are certainly not (part of) white space: characters beyond
    ASCII that may be are led by C2, E1, E2 or E3."""
    plain = np.zeros(256, bool)
    plain[0x21:0x7F] = True
    plain[0x80:] = True
    solid = plain[data]
    for lead, width in ((0xC2, 2), (0xE1, 3), (0xE2, 3), (0xE3, 3)):
        at = np.flatnonzero(data == lead)
        for k in range(width):
            solid[np.minimum(at + k, len(data) - 1)] = False
    return solid


def _piece_starts(data: np.ndarray, bounds: np.ndarray, solid: np.ndarray) -> np.ndarray:
    """Where texts start, and where a byte-level BPE with the usual splitting
    pattern may be cut within them.

    The pattern's runs hold white space only in front or on their own, so a lone
    space between two other characters always begins a run. So does a mark that
    follows a letter, unless it is an apostrophe. Cutting less often changes
    nothing.
    """
    cut = np.zeros(len(data), bool)
    cut[1:-1] = (data[1:-1] == SPACE) & solid[:-2] & solid[2:]
    cut[1:] |= LETTER[data[:-1]] & MARK[data[1:]]
    # A space at a text's end would look at the next text.
    cut[bounds[1:][bounds[1:] > 0] - 1] = False
    cut[bounds[:-1][bounds[:-1] < len(data)]] = True
    return np.flatnonzero(cut)


class _JsonTokenizer:
    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import json

        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        with open(path) as file:
            config = json.load(file)
        split = config.get("pre_tokenizer") or {}
        # Only this splitting is known to be cut safely; others take whole texts.
        self.pieces = (
            split.get("type") == "ByteLevel"
            and split.get("use_regex", True)
            and not split.get("add_prefix_space")
            and not config.get("normalizer")
        )
        self.special = [token["content"].encode() for token in config.get("added_tokens", [])]
        # A byte-level token is written with one character for each of its bytes.
        vocabulary = self.tokenizer.get_vocab()
        self.bytes_of = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for token, number in vocabulary.items():
            self.bytes_of[number] = len(token)
        self._forget()

    def _forget(self) -> None:
        self.known: dict[bytes, int] = {}
        self.ids = np.empty(1 << 16, np.int32)
        self.ends = np.zeros(CACHED_PIECES + 1, np.int64)

    def _encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, new: list[bytes], regular: np.ndarray) -> None:
        """Adds pieces. Regular ones, a lone space and solid characters at either
        end, are encoded as one text: it is split where they meet, and its ids
        are theirs by their bytes."""
        together = [piece for piece, r in zip(new, regular, strict=True) if r]
        alone = [piece for piece, r in zip(new, regular, strict=True) if not r]
        for start in range(0, len(together), TOGETHER):
            part = together[start : start + TOGETHER]
            (coded,) = self._encode([b"".join(part).decode()])
            ids = np.array(coded, np.int32)
            ends = np.cumsum([len(piece) for piece in part])
            of_ids = np.cumsum(self.bytes_of[ids])
            stops = np.searchsorted(of_ids, ends) + 1
            if (of_ids[stops - 1] != ends).any():
                raise ValueError("a token reaches over a cut")
            self._add(part, ids, np.diff(stops, prepend=0))
        for start in range(0, len(alone), TOGETHER):
            part = alone[start : start + TOGETHER]
            ids, bounds = _flat(self._encode([piece.decode() for piece in part]))
            self._add(part, ids, np.diff(bounds))

    def _add(self, pieces: list[bytes], ids: np.ndarray, lengths: np.ndarray) -> None:
        first = len(self.known)
        ends = self.ends[first] + np.cumsum(lengths)
        if ends[-1] > len(self.ids):
            self.ids = np.resize(self.ids, 2 * int(ends[-1]))
        self.ids[self.ends[first] : ends[-1]] = ids
        self.ends[first + 1 : first + 1 + len(pieces)] = ends
        self.known.update(zip(pieces, range(first, first + len(pieces)), strict=True))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        data, bounds = text_bytes(texts)
        if not len(data):
            return np.empty(0, np.int32), np.zeros(len(bounds), np.int64)
        raw = data.tobytes()
        whole = not self.pieces or any(special in raw for special in self.special)
        if not whole:
            solid = _solid(data)
            starts = _piece_starts(data, bounds, solid)
            stops = np.append(starts[1:], len(data))
            coded = binary_array(data, np.append(starts, len(data))).dictionary_encode()
            distinct = coded.dictionary.to_pylist()
            whole = len(distinct) > CACHED_PIECES
        if whole:
            return _flat(self._encode([raw[a:b].decode() for a, b in zip(bounds, bounds[1:])]))
        if len(self.known) + len(distinct) > CACHED_PIECES or self.ends[len(self.known)] > CACHED_IDS:
            self._forget()
        index = coded.indices.to_numpy(zero_copy_only=False)
        new = [i for i, piece in enumerate(distinct) if piece not in self.known]
        if new:
            place = np.empty(len(distinct), np.int64)
            place[index] = np.arange(len(index))
            at, stop = starts[place[new]], stops[place[new]]
            regular = (data[at] == SPACE) & (stop - at > 1) & solid[stop - 1]
            regular &= solid[np.minimum(at + 1, len(data) - 1)]
            self._learn([distinct[i] for i in new], regular)
        entry = np.fromiter(map(self.known.__getitem__, distinct), np.int64, len(distinct))
        entry = entry[index]
        first = self.ends[entry]
        lengths = self.ends[entry + 1] - first
        ends = np.concatenate(([0], np.cumsum(lengths)))
        at = np.arange(ends[-1]) + np.repeat(first - ends[:-1], lengths)
        return self.ids[at], ends[np.searchsorted(starts, bounds)]


class _SentencePiece:
    def __init__(self, path: str) -> None:
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        return _flat(self.model.encode(["" if t is None else t for t in texts.to_pylist()], num_threads=1))


def _flat(coded: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    bounds = np.concatenate(([0], np.cumsum([len(ids) for ids in coded], dtype=np.int64)))
    return np.fromiter((i for ids in coded for i in ids), np.int32, int(bounds[-1])), bounds


@cache
def tokenizer(path: str) -> _JsonTokenizer | _SentencePiece:
    """`encode(texts)` gives all ids end to end, and where each text's start.

    Nothing is added to a text, cut off or filled up; strings of special tokens
    in a text are read as the library does by default. Null is empty. A
    tokenizer is loaded once per worker.

    For byte-level BPE, texts are cut where the splitting pattern cuts them
    anyway, and each distinct piece is given to the library once per worker.
    """
    path = vocabulary(path)
    return _SentencePiece(path) if path.endswith(".model") else _JsonTokenizer(path)
