"""Verdicts of whole tables against a plain power iteration, with dangling ends and tiny seeds."""

import random

import numpy as np
import pytest

from demandtide.llm.url_filter import url_filter

RULES = (("allow", "good.org", "/"), ("block", "bad.org", "/"), ("block", "tiny.net", "/x/"))


def plain(rows, rules):
    hosts = sorted({h for h, _, links in rows} | {x for _, _, links in rows for x in links})
    at = {h: k for k, h in enumerate(hosts)}
    links = np.zeros((len(hosts), len(hosts)))
    for h, _, out in rows:
        for x in out:
            links[at[h], at[x]] = x != h

    def rule(host, path):
        fits = [(len(rh), len(rp), v) for v, rh, rp in rules if (host == rh or host.endswith("." + rh)) and path.startswith(rp)]
        return max(fits)[2] if fits else None

    found = [rule(h, p) for h, p, _ in rows]

    def rank(matrix, verdict):
        seed = np.zeros(len(hosts))
        for (h, _, _), v in zip(rows, found):
            seed[at[h]] += v == verdict
        if not seed.sum():
            return seed
        seed /= seed.sum()
        out, x = matrix.sum(axis=1), seed.copy()
        for _ in range(600):
            x = 0.15 * seed + 0.85 * ((x / np.maximum(out, 1)) @ matrix + x[out == 0].sum() * seed)
        return x

    trust, distrust = rank(links, "allow"), rank(links.T, "block")
    judged = [v or ("block" if distrust[at[h]] > (1 + 1e-6) * trust[at[h]] else "allow") for (h, _, _), v in zip(rows, found)]
    margin = [abs(distrust[at[h]] - trust[at[h]]) / max(distrust[at[h]], trust[at[h]], 1e-300) for h, _, _ in rows]
    return judged, margin


@pytest.mark.parametrize("seed", [1, 2])
def test_verdicts_of_a_random_graph(spark, seed):
    rng = random.Random(seed)
    hosts = [f"h{k}.net" for k in range(200)] + [f"g{k}.good.org" for k in range(5)] + ["bad.org", "tiny.net", "lonely.net"]
    rows = []
    for h in hosts:
        for _ in range(rng.choice([1, 1, 2, 300 if h == "bad.org" else 1])):
            # a third of the hosts have no links, a few many
            links = [] if rng.random() < 0.3 or h == "lonely.net" else rng.sample(hosts[:-1], rng.choice([1, 2, 3, 30]))
            rows.append((h, "/x/1" if h == "tiny.net" else "/p", links))
    pages = [(k, f"http://{h}{p}", "".join(f'<a href="http://{x}/">' for x in links), "x") for k, (h, p, links) in enumerate(rows)]
    frame = spark.createDataFrame(pages + [(9000, None, None, ""), (9001, "nothing", "", "")], "page_id long, url string, html string, host string")
    got = {r.page_id: r.verdict for r in url_filter(frame, RULES, site_links=False).collect()}
    want, margin = plain(rows, RULES)
    assert got.pop(9000) == got.pop(9001) == "allow"
    wrong = [k for k, v in enumerate(want) if got[k] != v]
    assert all(margin[k] < 1e-5 for k in wrong), [(rows[k][0], want[k], margin[k]) for k in wrong][:5]
    assert {"allow", "block"} <= set(want)


def test_no_seeds_and_no_rows(spark):
    frame = spark.createDataFrame([(1, "http://a.b/", '<a href="http://c.d/">')], "page_id long, url string, html string")
    assert [r.verdict for r in url_filter(frame, ()).collect()] == ["allow"]
    assert url_filter(frame.limit(0)).count() == 0
