"""Verdicts against plain Python: rules, link extraction, ranks as a matrix."""

import re
from collections import Counter

import numpy as np
import pytest

from cartstream.llm.link_graph import DAMPING, MARGIN, Rule, host_ranks, judge_pages
from cartstream.llm.queries import URL_RULES
from conftest import TESTDATA

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = str.maketrans(UPPER, UPPER.lower())
SCHEMA = "page_id long, url string, html string, host string, verdict string, kind string"


def parts(url):
    if not url or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host, path = re.match(r"([^/?#]*)([^?#]*)", rest).groups()
    return host.translate(LOWER), path


def rule_for(host, path, rules):
    fit = [
        (len(r.host + r.path), r.host + r.path, r.verdict)
        for r in rules
        if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)
    ]
    return max(fit, default=(0, None, None))[1:]


def ranks(rows, rules):
    link = re.compile(r"""<a\s[^>]*?href\s*=\s*["']?\s*(?:[a-z][a-z0-9+.\-]*:)?//([^"'\s>/?#]*)""", re.I)
    links, net, n = set(), Counter(), Counter()
    for _, url, html in rows:
        host, path = parts(url)
        if not host:
            continue
        n[host] += 1
        net[host] += {"allow": 1, "block": -1, None: 0}[rule_for(host, path, rules)[1]]
        for target in link.findall(html or ""):
            target = target.translate(LOWER)
            if target and target != host:
                links.add((host, target))
    for host in [*n, *(d for _, d in links)]:
        label = host.split(".")
        for i in range(len(label) - 2):
            pair = ".".join(label[i:]), ".".join(label[i + 1 :])
            links |= {pair, pair[::-1]}
    hosts = sorted(set(n) | {h for link in links for h in link})
    at = {h: i for i, h in enumerate(hosts)}
    out = {}
    for kind, sign in (("allow", 1), ("block", -1)):
        seed = np.array([max(sign * net[h] / max(n[h], 1), 0) for h in hosts])
        move = np.zeros((len(hosts), len(hosts)))
        for a, b in links:
            move[(at[a], at[b]) if kind == "allow" else (at[b], at[a])] = 1
        move += np.diag(move.sum(axis=1) == 0)
        move = move / move.sum(axis=1, keepdims=True)
        # The ranks that no step changes, solved at once.
        rank = np.linalg.solve(np.eye(len(hosts)) - DAMPING * move.T, (1 - DAMPING) * seed)
        out |= {(kind, h): v for h, v in zip(hosts, rank, strict=True) if v > 1e-9}
    return out


def brute(rows, rules):
    rank = ranks(rows, rules)
    out = Counter()
    for page_id, url, _ in rows:
        host, path = parts(url)
        rule, verdict = rule_for(host, path, rules)
        excess = rank.get(("block", host), 0) - rank.get(("allow", host), 0)
        by_host = "block" if excess > MARGIN else "allow"
        out[(page_id, host, path, rule, verdict or by_host)] += 1
    return out


def page_rows():
    link = '<p><A class=x HREF = "{}">t</a> <a href=/own>o</a>'.format
    rows = [
        (1, None, None), (2, "", ""), (3, "no scheme.org/en/", "<a href='//x.org'>"), (4, "http://", ""),
        (5, "HTTP://Example.ORG/es/1?x#y", link("https://spam.net/a")),
        (6, "https://example.org/en/12", link("//SPAM.net")), (7, "https://badexample.org/es/", ""),
        (8, "https://a.example.org?q=/es/", ""), (9, "http://x.com/de/1", link("http://good.net/?q")),
        (10, "http://x.com/de/2", link("http://bad.net")), (11, "http://good.net/x", link("http://x.com/de/3")),
        (12, "http://bad.net/x", link("http://x.com/")), (13, "http://blog.bad.net/x", None),
        (14, "http://spam.net/x", link("http://example.org/es/")), (15, "http://x.org://y/z", ""),
        (16, "http://u:p@h.org:80/en", "x" * 50_000), (None, "http://bad.net/y", "<a href="),
        (17, "ftp://x.com" + "/fr" * 9000 + "/", ""), (18, "http://ÄX.org/É?", "<a\nhref='http://bad.net'>"),
    ]
    return rows + [(100 + i, "http://x.com/de/9", link("http://bad.net/9")) for i in range(40)] + rows[8:12]


def frame(spark, rows):
    return spark.createDataFrame([(*r, "h", "v", "k") for r in rows], SCHEMA).repartition(3)


@pytest.mark.parametrize(
    "rules", [URL_RULES, (), (Rule("block", "net", "/x"), Rule("allow", "net", "/x"))]
)
def test_awkward_pages(llm_spark, rules):
    rows = page_rows()
    result = Counter(map(tuple, judge_pages(frame(llm_spark, rows), rules).collect()))
    assert result == brute(rows, rules)
    if rules == URL_RULES:
        assert {r[4] for r in result if r[3] is None} == {"allow", "block"}


def test_ranks(llm_spark):
    rows = page_rows()
    expected = ranks(rows, URL_RULES)
    result = {(r.kind, r.node): r.value for r in host_ranks(frame(llm_spark, rows), URL_RULES).collect()}
    assert {k for k in result if result[k] > 1e-5} == {k for k in expected if expected[k] > 1e-5}
    assert all(abs(result.get(k, 0) - expected[k]) < 1e-5 for k in expected)


def test_a_chain_of_any_length_is_followed(llm_spark):
    """Distrust reaches every host of a chain that leads to a blocked one."""
    rows = [(i, f"http://h{i}.net/", f"<a href='//h{i + 1}.net'>") for i in range(30)]
    rows += [(100, "http://h30.net/x", "")]
    result = {r.node: r.value for r in host_ranks(frame(llm_spark, rows), (Rule("block", "h30.net", "/"),)).collect()}
    assert len(result) > 18 and abs(sum(result.values()) - 1) < 1e-5
    assert all(abs(result[f"h{30 - i}.net"] - 0.5 ** (i + 1)) < 1e-5 for i in range(15))


@pytest.mark.parametrize("others", [0, 1, 40])
def test_equal_hosts_get_equal_verdicts_whatever_others_there_are(llm_spark, others):
    rules = (Rule("block", "bad.net", "/x"), Rule("block", "else.org", "/"), Rule("allow", "fine.org", "/"))
    rows = [(1, "http://bad.net/x", ""), (2, "http://bad.net/y", ""), (3, "http://a.bad.net/z", "")]
    rows += [(4, "http://good.net/x", ""), (5, "http://friend.net/", "<a href='//bad.net'>")]
    alone = ranks(rows, rules)
    rows += [(100 + i, f"http://e{i}.else.org/", "") for i in range(others)]
    rows += [(200 + i, f"http://e{i}.fine.org/", "") for i in range(others)]
    verdict = {r.page_id: r.verdict for r in judge_pages(frame(llm_spark, rows), rules).collect()}
    assert [verdict[i] for i in (1, 2, 3, 4, 5)] == ["block", "block", "allow", "allow", "block"]
    found = {(r.kind, r.node): r.value for r in host_ranks(frame(llm_spark, rows), rules).collect()}
    assert len(alone) == 3 and all(abs(found[k] - alone[k]) < 1e-5 for k in alone)


def test_parent_domains_join_their_hosts(llm_spark):
    """No page or link names the domain; still distrust gets from host to host."""
    rows = [(1, "http://a.shop.bad.net/x", ""), (2, "http://b.shop.bad.net/y", "")]
    found = host_ranks(frame(llm_spark, rows), (Rule("block", "a.shop.bad.net", "/"),)).collect()
    assert {r.node for r in found} == {"a.shop.bad.net", "b.shop.bad.net", "shop.bad.net", "bad.net"}


def test_distrust_moves_over_the_given_hosts(llm_spark):
    pages = llm_spark.read.parquet(f"{TESTDATA}/sf0.01/pages.parquet")
    seeds = judge_pages(pages, URL_RULES).where("rule is not null").select("host").distinct()
    reached = host_ranks(pages, URL_RULES).where("kind = 'block'").select("node")
    assert reached.count() > 3 and not reached.join(seeds, reached.node == seeds.host, "left_anti").isEmpty()


def test_given_pages_and_no_pages(llm_spark):
    pages = llm_spark.read.parquet(f"{TESTDATA}/sf0.01/pages.parquet")
    rows = [(r.page_id, r.url, r.html) for r in pages.collect()]
    judged = judge_pages(pages, URL_RULES)
    assert Counter(map(tuple, judged.collect())) == brute(rows, URL_RULES)
    plan = judged._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert judge_pages(frame(llm_spark, []), URL_RULES).isEmpty()
