"""Mixing, URL filters and nearest neighbours."""

import math
import random
import re

import numpy as np
from pyspark.sql import functions as F

from rillet.llm import ann, mixing, urls


def targets_of(sizes, weights=(1, 2, 3), limit=3.0):
    """Share by weight, cut at the limit, share the rest again until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    full, rest = set(), float(sum(sizes.values()))
    while True:
        left = rest - sum(limit * sizes[s] for s in full)
        share = left / (sum(weight[s] for s in names if s not in full) or 1)
        over = {s for s in names if s not in full and share * weight[s] > limit * sizes[s]}
        if not over:
            return {s: limit * sizes[s] if s in full else share * weight[s] for s in names}
        full |= over


def test_mix_follows_the_targets(spark):
    rng = random.Random(4)
    rows = [(i, " ".join(["w"] * rng.randint(0, 60)), rng.choice(["a"] * 12 + ["b", "b", "ü", "Z", None, "one"])) for i in range(3000)]
    rows += [(9000, "x", "tiny"), (9001, None, "nothing"), (9002, " \n\t ", "nothing"), (None, "a\x0bb\x0cc\rd", "b"), (7, "again", "a"), (7, "again", "a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("size", F.lit(-1)).withColumn("_place", F.lit(0))
    out = mixing.mix(docs.repartition(5))
    got = out.collect()
    assert len(got) == len(rows) and out.columns == ["doc_id", "text", "source", "_place", "size", "source_size", "target", "copies"]
    sizes = {}
    for r in got:
        assert r["size"] == len(re.findall(r"[^\x20\x09-\x0d]+", r["text"] or "")) and 0 <= r["copies"] <= 3
        sizes[r["source"]] = sizes.get(r["source"], 0) + r["size"]
    want = targets_of(sizes)
    for s in sizes:
        mine = [r for r in got if r["source"] == s]
        assert {r["source_size"] for r in mine} == {sizes[s]}
        assert math.isclose(mine[0]["target"], want[s], rel_tol=1e-12, abs_tol=1e-9)
        assert abs(sum(r["copies"] * r["size"] for r in mine) - want[s]) <= max(0.02 * want[s], 130)
    rerun = mixing.mix(docs.repartition(3)).collect()
    assert sorted((r["doc_id"] or -1, r["copies"]) for r in got) == sorted((r["doc_id"] or -1, r["copies"]) for r in rerun)
    assert mixing.materialise(out).count() == sum(r["copies"] for r in got)
    assert mixing.mix(docs.limit(0)).count() == 0


def judged(url, rules):
    rest = (url or "").split("://", 1)[1] if "://" in (url or "") else ""
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host):])[0]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    met = [(len(h) + len(p), len(h), v == "block", h + p, v) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(met, default=(0, 0, 0, None, "allow"))
    return host, path, best[3], best[4]


def test_url_rules_equal_brute_force(spark):
    rules = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"),
             ("block", "a.example.org", "/fr/x"), ("allow", "b.co.uk", ""), ("block", "co.uk", "/p/q/")]
    rng = random.Random(6)
    hosts = ["net", "x.net", "Example.NET", "www.example.net", "notexample.com", "m.example.com", "a.example.org", "org", "b.co.uk", "z.co.uk", "net:80", "", "a..net"]
    paths = ["", "/", "/en", "/en/", "/en/7?x=/de/", "/de/1#top", "/fr/xyz", "/fr/", "//en/", "/p/q/r", "?a=://b", "#/", "/é/ü", "/" * 3000]
    links = [f"{rng.choice(['http', 'https', ''])}://{rng.choice(hosts)}{rng.choice(paths)}" for _ in range(400)] + [None, "", "no scheme", "http:/x.net/", "a\n://x.net/"]
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(links)] + [(0, links[0]), (None, links[1])], "page_id long, url string")
    pages = pages.withColumn("rule", F.lit("old")).withColumn("short", F.lit("s"))
    out = urls.judge(pages, urls.rule_table(spark, rules))
    rows = out.collect()
    assert len(rows) == len(links) + 2 and out.columns == ["page_id", "url", "short", "host", "path", "rule", "verdict"]
    for r in rows:
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == judged(r["url"], rules)
    none = urls.judge(pages, urls.rule_table(spark, rules).limit(0))
    assert {r["verdict"] for r in none.collect()} == {"allow"}
    assert urls.judge(pages.limit(0), urls.rule_table(spark, rules)).count() == 0


def nearest(rows, k):
    ids = np.array([i for i, _ in rows])
    x = np.array([v for _, v in rows])
    out = {}
    for q in sorted({i for i in ids.tolist() if i % 20 == 0}):
        score = (x * x[ids == q][0]).sum(axis=1)
        at = np.flatnonzero(ids != q)
        best = at[np.lexsort((ids[at], -score[at]))][:k]
        out[q] = [(int(ids[i]), float(score[i])) for i in best]
    return out


def vectors(n, scale=1.0, seed=0):
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((n, 16)) * (1 if scale == 1.0 else rng.uniform(0.1, scale, size=(n, 1)))
    x[5:40] = x[4]  # one common vector: ties
    return [(i, x[i].tolist()) for i in range(n)]


def test_nearest_recall(spark):
    for rows in (vectors(1500), vectors(1500, scale=5.0, seed=1)):
        odd = [(10_020, None), (10_040, [0.0] * 16), (10_060, [float("nan")] + [1.0] * 15), (10_080, [None] * 16), (10_100, [1.0, 2.0]), (None, [1.0] * 16),
               (10_120, [float("inf")] * 16)]
        df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>").withColumn("score", F.lit(1))
        found = ann.search(df, df.where("vec_id % 20 = 0"), block=400, query_block=30).collect()
        want = nearest(rows, 20)
        got = {}
        for r in sorted(found, key=lambda r: r["rank"]):
            got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert set(got) == set(want)
        share = np.mean([len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / 20 for q in want])
        assert share >= 0.95
        for q, list_ in got.items():
            assert list_ == sorted(list_, key=lambda t: (-t[1], t[0])) and len(list_) == 20
            v = np.array(rows[q][1])
            assert all(abs(s - float(np.dot(np.array(rows[i][1]), v))) < 1e-9 for i, s in list_)
        assert [i for i, _ in got[20]] == [i for i, _ in want[20]]  # equal vectors: the smaller ids


def test_nearest_of_few_rows(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, [0.5, 0.5]), (2, [0.1, 0.1])], "vec_id long, embedding array<float>")
    got = [tuple(r) for r in ann.search(df, df.where("vec_id % 20 = 0")).orderBy("rank").collect()]
    assert [(q, r, v) for q, r, v, _ in got] == [(0, 1, 1), (0, 2, 2), (0, 3, 2)]
    assert ann.search(df.limit(0), df.limit(0)).count() == 0
