"""URL filters: explicit rules first, link-graph trust for the rest.

Hosts that rules allow are trusted seeds, hosts that rules block are blocked
seeds. Personalised PageRank carries trust along host links; distrust runs
along the reversed links, from a blocked host to those that point at it. A host
without a rule is blocked when its distrust exceeds ``threshold`` times its trust.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from demandtide.llm.storage import held, removed, stored

#: Fixed rules of the query: (verdict, host, path).
RULES = (
    ("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/"),
)
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://``."""
    return F.coalesce(F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def matching_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> Column:
    """Struct of the longest fitting rule (rule, verdict); null where none fits. Host length decides, then path length."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, rule_host, rule_path in sorted(rules, key=lambda r: (len(r[1]), len(r[2]))):
        fits = ((host == rule_host) | host.endswith(f".{rule_host}")) & path.startswith(rule_path)
        found = F.when(fits, F.struct(F.lit(rule_host + rule_path).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def host_edges(pages: DataFrame, site_links: bool = True) -> DataFrame:
    """Distinct (src, dst) host links: absolute hyperlinks of the pages and, if wanted, both ways between a host and the
    site one label above it, where that site keeps at least two labels. Links of a host to itself do not count."""
    links = F.expr(r"regexp_extract_all(html, '(?i)(?:href|src)\\s*=\\s*[\"'']?\\s*((?:https?:)?//[^\\s\"''<>]*)', 1)")
    out = pages.select("host", F.explode(F.array_distinct(F.transform(links, lambda u: host_of(F.concat(F.lit("x:"), F.regexp_replace(u, r"^(?i:https?:)", "")))))).alias("dst"))
    edges = out.select(F.col("host").alias("src"), "dst")
    if site_links:
        hosts = pages.select("host").distinct()
        up = hosts.select("host", F.regexp_extract("host", r"^[^.]+\.([^.]+(?:\.[^.]+)+)$", 1).alias("site")).filter("site <> ''")
        edges = edges.unionByName(up.select(F.col("host").alias("src"), F.col("site").alias("dst"))).unionByName(up.select(F.col("site").alias("src"), F.col("host").alias("dst")))
    return edges.filter("src <> dst and src <> '' and dst <> ''").distinct()


def _weighted(edges: DataFrame) -> DataFrame:
    """Stored (side, src, dst, share): a link carries an equal part of what its source passes on."""
    degree = edges.groupBy("side", "src").agg(F.count("*").alias("n"))
    return stored(edges.join(degree, ["side", "src"]).select("side", "src", "dst", (F.lit(1.0) / F.col("n")).alias("share")), "host-links")


def _round(links: DataFrame, state: DataFrame, damping: float) -> DataFrame:
    """What each host got last moves on along its links and is added where it arrives."""
    got = state.select("side", F.col("host").alias("src"), "fresh").filter("fresh > 0")
    moved = links.join(got, ["side", "src"]).select("side", F.col("dst").alias("host"), F.lit(0.0).alias("score"), (damping * F.col("fresh") * F.col("share")).alias("fresh"))
    both = state.select("side", "host", "score", F.lit(0.0).alias("fresh")).unionByName(moved)
    return both.groupBy("side", "host").agg((F.sum("score") + F.sum("fresh")).alias("score"), F.sum("fresh").alias("fresh"))


def undecided(state: DataFrame, total: dict[int, float], ahead: dict[int, float], threshold: float) -> int:
    """Hosts with both scores whose verdict what is still on its way could turn.

    A side holds ``total`` and gets at most ``ahead`` more, of which a host may get all
    or nothing: its share of the sum lies between s / (total + ahead) and (s + ahead) / (total + ahead).
    """
    scores = [F.sum(F.when(F.col("side") == side, F.col("score")).otherwise(0.0)).alias(name) for side, name in ((0, "trust"), (1, "distrust"))]
    hosts = state.groupBy("host").agg(*scores).filter("trust > 0 and distrust > 0")
    most = [F.lit(total.get(side, 0.0) + ahead.get(side, 0.0)) for side in (0, 1)]
    more = [F.lit(ahead.get(side, 0.0)) for side in (0, 1)]
    blocked = F.col("distrust") / most[1] > threshold * (F.col("trust") + more[0]) / most[0]
    allowed = (F.col("distrust") + more[1]) / most[1] <= threshold * F.col("trust") / most[0]
    return hosts.filter(~blocked & ~allowed).count()


def spread(edges: DataFrame, seeds: DataFrame, damping: float, iterations: int | None = None, tolerance: float = 1e-6, threshold: float | None = None) -> DataFrame:
    """Personalised PageRank of several sides at once: (side, host, score) from ``seeds`` (side, host, weight) along ``edges`` (side, src, dst).

    score = (1 - damping) * seed + damping * sum of score / out-degree over the incoming
    links. Only what was new in the last round is carried on, in one join and one partial
    sum for all sides. Two rounds are one stored table of few rows, and the table before
    is taken away. Rounds end after ``iterations``; or when no side has more than
    ``tolerance`` of its sum on its way (at most the last arrivals times damping / (1 - damping)); or,
    given ``threshold``, when no further host is reached and no comparison of sides 0 and 1 can turn.
    """
    spark, links = edges.sparkSession, _weighted(edges)
    state, folder = held(seeds.select("side", "host", ((1 - damping) * F.col("weight")).alias("score"), ((1 - damping) * F.col("weight")).alias("fresh")), "host-scores")
    files, done, reached = 1 + links.count() // 500_000, 0, -1  # a host of the scores has a link or is a seed
    while iterations is None or done < iterations:
        steps = 2 if iterations is None else min(2, iterations - done)
        following = state
        for _ in range(steps):
            following = _round(links, following, damping)
        following, new = held(following.coalesce(files), "host-scores")
        removed(spark, folder)
        state, folder, done = following, new, done + steps
        sums = {r.side: r for r in state.groupBy("side").agg(F.sum("score").alias("total"), F.sum("fresh").alias("fresh"), F.count("*").alias("n")).collect()}
        if iterations is not None:
            continue
        total, ahead = {k: r.total for k, r in sums.items()}, {k: r.fresh * damping / (1 - damping) for k, r in sums.items()}
        if all(ahead[k] <= tolerance * total[k] for k in sums):
            break
        before, reached = reached, sum(r.n for r in sums.values())
        if threshold is not None and before == reached and not undecided(state, total, ahead, threshold):
            break
    return state.select("side", "host", "score")


def propagate(edges: DataFrame, seeds: DataFrame, damping: float, iterations: int | None = None, every: int = 2, tolerance: float = 1e-6) -> DataFrame:
    """``spread`` of one side: (host, score) from ``seeds`` (host, weight) along ``edges`` (src, dst).

    What hosts without outgoing links hold would return to the seeds in proportion, which
    scales all scores alike: dividing by their sum (``shares``) gives the scores with that return.
    """
    side = F.lit(0).alias("side")
    return spread(edges.select(side, "src", "dst"), seeds.select(side, "host", "weight"), damping, iterations, tolerance).drop("side")


def shares(scores: DataFrame) -> DataFrame:
    """Scores divided by their sum."""
    total = scores.agg(F.sum("score")).first()[0] or 1.0
    return scores.select("host", (F.col("score") / F.lit(total)).alias("score"))


def url_filter(
    pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, damping: float = 0.85, iterations: int | None = None, threshold: float = 1.0, site_links: bool = True, tolerance: float = 1e-6
) -> DataFrame:
    """page_id, host, path, rule, verdict of every page (columns read: page_id, url, html).

    Null urls and urls without ``://`` have an empty host and path; they fit no rule
    and, without any score, are allowed. A seed's weight is the share of all ruled
    pages that its host has on that side, so copies of a page count as pages. A null
    html has no links. Repeated rows stay; an empty table gives no rows. Hosts, not
    pages, take part in the rounds: pages and links are first summed per host with a
    partial aggregate, so a host with a third of the pages is one row. Trust and distrust
    each sum to 1 over all hosts and are compared relative to their size, distrust having
    to exceed the rest by ``tolerance`` of it, so a verdict does not depend on how many
    hosts and seeds there are.
    """
    parsed = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), "html")
    parsed = parsed.withColumn("found", matching_rule(F.col("host"), F.col("path"), rules))
    ruled = parsed.filter("found is not null").groupBy("host").agg(
        F.count_if(F.col("found.verdict") == "allow").alias("allow"), F.count_if(F.col("found.verdict") == "block").alias("block")
    )
    ruled = stored(ruled, "seed-hosts")
    total = ruled.agg(F.sum("allow").alias("a"), F.sum("block").alias("b")).first()
    edges = stored(host_edges(parsed, site_links), "host-edges")
    both = edges.select(F.lit(0).alias("side"), "src", "dst").unionByName(edges.select(F.lit(1).alias("side"), F.col("dst").alias("src"), F.col("src").alias("dst")))
    weights = [ruled.filter(F.col(c) > 0).select(F.lit(side).alias("side"), "host", (F.col(c) / F.lit(n or 1)).alias("weight")) for side, c, n in ((0, "allow", total.a), (1, "block", total.b))]
    found = spread(both, weights[0].unionByName(weights[1]), damping, iterations, tolerance, threshold * (1 + tolerance))
    sums = {r.side: r.total for r in found.groupBy("side").agg(F.sum("score").alias("total")).collect()}
    scores = found.groupBy("host").agg(*[(F.sum(F.when(F.col("side") == side, F.col("score")).otherwise(0.0)) / F.lit(sums.get(side, 1.0))).alias(name) for side, name in ((0, "trust"), (1, "distrust"))])
    blocked = stored(scores.filter(F.col("distrust") > threshold * (1 + tolerance) * F.col("trust")).select("host", F.lit(True).alias("distrusted")), "blocked-hosts")
    judged = parsed.drop("html").join(blocked, "host", "left")
    return judged.select(
        "page_id", "host", "path", F.col("found.rule").alias("rule"),
        F.coalesce(F.col("found.verdict"), F.when(F.col("distrusted"), "block").otherwise("allow")).alias("verdict"),
    )
