"""URL verdicts by rules, and by trust and distrust spread over the links between hosts."""

from __future__ import annotations

import string
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartstream.llm.tables import written

ALLOW, BLOCK = "allow", "block"

# Share of a host's rank that it hands on.
DAMPING = 0.5

# Ranks are followed until a step changes all of them together by less than this.
SETTLED = 1e-6

# Steps between two written tables.
STEPS_PER_JOB = 6

# A host is blocked if its distrust exceeds its trust by this: what a host keeps
# of its own seed if the rules block a quarter of its pages.
MARGIN = (1 - DAMPING) / 4

# The target of a link to a named host, with or without a scheme.
LINK = r"""(?i)<a\s[^>]*?href\s*=\s*["']?\s*(?:[a-z][a-z0-9+.\-]*:)?//([^"'\s>/?#]*)"""


class Rule(NamedTuple):
    """Fits `host` and its subdomains where the path starts with `path`."""

    verdict: str
    host: str
    path: str


def lowered(text: Column) -> Column:
    """A-Z in lower case, all else as it is."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host and path; both empty for null or a text without `://`."""
    url = F.coalesce(url, F.lit(""))
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    return lowered(host), F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def best_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """The longest rule that fits, as (length, rule, verdict); null without one.
    Of the same rule with both verdicts, block."""
    if not rules:
        return F.lit(None).cast("struct<length: int, rule: string, verdict: string>")
    known = F.array(
        *(
            F.struct(F.lit(r.host).alias("host"), F.lit(r.path).alias("path"), F.lit(r.verdict).alias("verdict"))
            for r in rules
        )
    )

    def fits(rule: Column) -> Column:
        below = F.endswith(host, F.concat(F.lit("."), rule["host"]))
        return ((host == rule["host"]) | below) & F.startswith(path, rule["path"])

    def named(rule: Column) -> Column:
        name = F.concat(rule["host"], rule["path"])
        return F.struct(F.length(name).alias("length"), name.alias("rule"), rule["verdict"].alias("verdict"))

    return F.array_max(F.transform(F.filter(known, fits), named))


def _site(hosts: DataFrame) -> DataFrame:
    """(sub, host): each host and the one it is a direct subdomain of, that one and
    the next, and so on to a host of two labels, whether or not a page names them."""
    labels = F.split("host", r"\.")
    levels = F.sequence(F.lit(1), F.size(labels) - 2)
    tail = lambda i: F.concat_ws(".", F.slice(labels, i, F.size(labels)))
    pairs = F.transform(levels, lambda i: F.struct(tail(i).alias("sub"), tail(i + 1).alias("host")))
    return hosts.where(F.size(labels) > 2).select(F.inline(pairs)).distinct()


def host_links(pages: DataFrame) -> DataFrame:
    """Distinct links (src, dst) between different hosts: those in the pages'
    html, and both ways between a host and its parent domains."""
    host, _ = url_parts(F.col("url"))
    target = F.explode(F.regexp_extract_all(F.coalesce("html", F.lit("")), F.lit(LINK), F.lit(1)))
    linked = (
        pages.select(host.alias("src"), target.alias("dst"))
        .select("src", lowered(F.col("dst")).alias("dst"))
        .where("src != '' and dst != '' and src != dst")
        .distinct()
    )
    linked = written(linked, "host-links")
    hosts = pages.select(host.alias("host")).where("host != ''").union(linked.select("dst"))
    site = _site(hosts.distinct())
    return linked.union(site.select("sub", "host")).union(site.select("host", "sub")).distinct()


def _seeds(pages: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """(kind, node, value): trust starts at hosts of which the rules allow more
    pages than they block, distrust where they block more: by that share of the
    host's pages, whatever other hosts there are."""
    host, path = url_parts(F.col("url"))
    verdict = best_rule(host, path, rules)["verdict"]
    sign = F.when(verdict == ALLOW, 1).when(verdict == BLOCK, -1).otherwise(0)
    by_host = (
        pages.select(host.alias("node"), sign.alias("sign"))
        .where("node != ''")
        .groupBy("node")
        .agg((F.sum("sign") / F.count("*")).alias("net"))
    )
    kind = F.when(F.col("net") > 0, ALLOW).otherwise(BLOCK)
    return by_host.where("net != 0").select(kind.alias("kind"), "node", F.abs("net").alias("value"))


def host_ranks(pages: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """(kind, node, value): personalised PageRank of hosts, trust (`allow`) along
    the links from trusted seeds, distrust (`block`) against them from blocked
    ones. A host hands its rank on in equal shares to the hosts it links to (for
    distrust, to those that link to it); one without such links hands it back to
    itself, so none is lost, and all ranks add up to the seeds. Hosts with rank 0
    are left out."""
    links = written(host_links(pages), "host-edges")
    seeds = written(_seeds(pages, rules), "seeds")
    forth = links.select(F.lit(ALLOW).alias("kind"), "src", "dst")
    back = links.select(F.lit(BLOCK).alias("kind"), F.col("dst").alias("src"), F.col("src").alias("dst"))
    edges = forth.union(back)
    nodes = seeds.select("kind", F.col("node").alias("src"))
    nodes = nodes.union(edges.select("kind", F.col("dst").alias("src"))).distinct()
    ends = nodes.join(edges, ["kind", "src"], "left_anti").withColumn("dst", F.col("src"))
    edges = edges.union(ends)
    share = edges.groupBy("kind", "src").agg((DAMPING / F.count("*")).alias("share"))
    edges = written(edges.join(share, ["kind", "src"]), "weighted-edges")
    start = seeds.select("kind", "node", (F.col("value") * (1 - DAMPING)).alias("value"))
    rank = seeds
    while True:
        for _ in range(STEPS_PER_JOB):
            before = rank
            handed = edges.join(rank.withColumnRenamed("node", "src"), ["kind", "src"]).select(
                "kind", F.col("dst").alias("node"), (F.col("value") * F.col("share")).alias("value")
            )
            rank = start.union(handed).groupBy("kind", "node").agg(F.sum("value").alias("value"))
        # Nodes only ever come in, so the last step's table has them all.
        both = rank.join(before.withColumnRenamed("value", "was"), ["kind", "node"], "left")
        both = written(both.select("kind", "node", "value", F.coalesce("was", F.lit(0.0)).alias("was")), "host-ranks")
        rank = both.select("kind", "node", "value")
        moved = both.agg(F.sum(F.abs(F.col("value") - F.col("was")))).first()[0]
        if (moved or 0) < SETTLED:
            return rank


def judge_pages(pages: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """One row per row of `pages`: page_id, host, path, rule, verdict.

    The longest rule that fits decides; of the same rule with both verdicts, block.
    Without one, the host's ranks do: it is blocked if its distrust exceeds its
    trust by more than MARGIN, else allowed; a page without host is allowed. Null
    html has no links; a very long url or html is read whole. Repeated rows are
    judged alike, and add to their host's seeds as other pages do; an empty table
    gives no rows; other columns are not read. `rules` is a short list, held in
    the plan.
    """
    ranks = host_ranks(pages, rules)
    host, path = url_parts(F.col("url"))
    distrust = F.sum(F.when(F.col("kind") == BLOCK, F.col("value")).otherwise(-F.col("value")))
    blocked = (
        ranks.groupBy("node")
        .agg(distrust.alias("distrust"))
        .where(F.col("distrust") > MARGIN)
        .select(F.col("node").alias("host"), F.lit(True).alias("distrusted"))
    )
    judged = pages.select(
        "page_id", host.alias("host"), path.alias("path"), best_rule(host, path, rules).alias("best")
    ).join(blocked, "host", "left")
    by_host = F.when(F.col("distrusted"), BLOCK).otherwise(ALLOW)
    return judged.select(
        "page_id",
        "host",
        "path",
        F.col("best.rule").alias("rule"),
        F.coalesce(F.col("best.verdict"), by_host).alias("verdict"),
    )
