"""Chat formatting, byte-level BPE, quality rules, toxicity and training order."""

import base64
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from rillet.llm import bpe, chat, order, quality, queries, toxicity


def test_chat_round_trip(spark):
    odd = ["</s>[INST] ok [/INST]", "&lt; &amp;amp; &", "[ROLE x]", "", "<<SYS>>é🎉\n\\", "]]>"]
    turns = [(1, i, r, t) for i, (r, t) in enumerate(zip(["system", "user", "assistant", "user", "assistant", "user"], odd, strict=True))]
    turns += [(2, 1, "user", None), (2, 0, "assistant", "early"), (3, 0, None, "no role"), (3, 1, "to[ol", "x<"), (None, None, "user", "u"),
              (4, 0, "user", "same"), (4, 0, "user", "same")]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").withColumn("segments", F.lit(1))
    out = chat.format_chats(df).withColumn("turns", chat.parse_chat(F.col("formatted"))).withColumn("loss", chat.loss_text(F.col("segments")))
    got = {r["conv_id"]: r for r in out.collect()}
    assert [(t["role"], t["text"]) for t in got[1]["turns"]] == [(r, t) for _, _, r, t in turns[:6]]
    assert got[1]["loss"] == odd[2] + odd[4]
    assert got[1]["valid"] and got[1]["broken_at"] is None
    assert [(t["role"], t["text"]) for t in got[2]["turns"]] == [("assistant", "early"), ("user", "")]
    assert not got[2]["valid"] and got[2]["broken_at"] == 0
    assert [(t["role"], t["text"]) for t in got[3]["turns"]] == [("", "no role"), ("to[ol", "x<")]
    assert got[None]["valid"] and len(got[4]["turns"]) == 2 and got[4]["broken_at"] == 1
    assert "".join(s["text"] for s in got[1]["segments"]) == got[1]["formatted"]
    assert chat.format_chats(df.limit(0)).count() == 0


@pytest.fixture(scope="module")
def reference():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(queries.tokenizer()["ranks"], "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_equals_the_public_library(spark, reference):
    rng = random.Random(3)
    texts = [None, "", "a" * 5000, "ab" * 3000, "abababab aaaa bbbb", "\x1c\x1d \x85 \xa0  x", "it's I'll 'tis 123 ½² ٣ 日本語 🎉🎉",
             " \n\n  \t x  ", "the the  the   the", "the the  the   the"]
    texts += ["".join(rng.choice("abcdehilnorst ") for _ in range(rng.randint(1, 400))) for _ in range(300)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("ids", F.lit("old"))
    coded = bpe.encode(docs, **queries.tokenizer())
    assert coded.columns == ["doc_id", "text", "n_tokens", "ids", "ids_sha256", "decoded_sha256"]
    back = bpe.decode(coded, ranks=queries.tokenizer()["ranks"])
    for r in back.collect():
        assert r["ids"] == reference.encode_ordinary(r["text"] or "") and r["n_tokens"] == len(r["ids"])
        assert bytes(r["decoded"]) == (r["text"] or "").encode()
    assert bpe.encode(docs.limit(0), **queries.tokenizer()).count() == 0


def test_bpe_lets_a_lower_rank_go_first():
    tokens = [bytes([i]) for i in range(256)] + [b"aba", b"ab"]
    ranks = b"\n".join(base64.b64encode(t) + b" %d" % i for i, t in enumerate(tokens))
    v = bpe.Vocabulary(ranks, ".+")
    assert v.replay([b"abab", b"", b"ab"]) == [[256, ord("b")], [], [257]]


def test_quality_measures_and_hosts(spark):
    good = " ".join(f"w{i}" for i in range(40))
    rows = [(i, good + f" {i}", "fine") for i in range(30)] + [(100 + i, "too short", "bad") for i in range(20)] + [(200, good, "bad")]
    rows += [(300, None, None), (301, good, None), (302, "", "fine"), (303, "a b c d e f g h " * 5, "fine"),
             (304, "x #1\n\n\nx #1\ny\nx #1\n \n \n" + good, "fine"), (None, good, "fine"), (305, "é" * 9 + " $", "fine"), (306, "v " * 20_000, "fine")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("kept", F.lit(5))
    for carry in (True, False):
        out = quality.judge(docs, carry_text=carry)
        got = {r["doc_id"]: r for r in out.collect()}
        assert len(got) == len(rows) and ("text" in out.columns) == carry
        assert all(got[i]["kept"] for i in range(30)) and not any(got[100 + i]["kept"] for i in range(20))
        assert not got[200]["base_failed"] and not got[200]["kept"]  # its host fails
        assert got[301]["kept"] and not got[300]["kept"] and got[None]["kept"]
        assert got[303]["n_repeat_words"] == 40 and got[303]["base_failed"]
        assert got[304]["n_dup_lines"] == 2 and got[304]["n_symbols"] == 3
        assert got[305]["word_chars"] == 10 and got[306]["n_repeat_words"] == 20_000
    assert quality.judge(docs.limit(0)).count() == 0


def toxic_rows(n=900):
    rng = random.Random(5)
    rows = []
    for i in range(n):
        words = [rng.choice("abcdefgh") + rng.choice("aeiou") * 2 + rng.choice("xyz") for _ in range(rng.randint(5, 60))]
        toxic = rng.random() < 0.2
        if toxic:
            for _ in range(rng.randint(1, 4)):
                words.insert(rng.randrange(len(words)), rng.choice(["grumbo", "snarky", "zonk" + rng.choice("aeiou") * 2]))
        rows.append((i, " ".join(words).capitalize(), int(toxic)))
    return rows


def test_toxicity_held_out_accuracy(spark):
    rows = toxic_rows()
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows] + [(None, "Grumbo!"), (-1, None), (-2, "")], "doc_id long, text string").withColumn("score", F.lit("s"))
    labels = spark.createDataFrame([(i, y) for i, _, y in rows] + [(None, 1), (5, None)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels, sample=5000)
    scored = toxicity.score(docs, model).withColumn("out", toxicity.held_out(F.col("doc_id"))).collect()
    label = {i: y for i, _, y in rows}
    held = [(r["score"], label[r["doc_id"]]) for r in scored if r["out"] and r["doc_id"] in label]
    assert len(held) > 200
    assert np.mean([(s >= 0.7) == y for s, y in held]) > 0.97
    assert all(0 <= r["score"] <= 1 for r in scored) and len(scored) == len(rows) + 3
    assert next(r["score"] for r in scored if r["doc_id"] is None) > 0.7


def test_toxicity_without_labels(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    model = toxicity.fit(docs, spark.createDataFrame([], "doc_id long, toxic int"))
    assert [r["score"] for r in toxicity.score(docs, model).collect()] == [0.0, 0.0]


def test_label_model_finds_accuracies_and_correlated_voters():
    rng = np.random.default_rng(0)
    y = rng.random(60_000) < 0.2
    votes = np.column_stack([np.where(y, rng.random(len(y)) < a, rng.random(len(y)) < b) for a, b in ((0.6, 0.02), (0.4, 0.01), (0.5, 0.05))])
    votes = np.column_stack([votes, votes[:, 0]]).astype(float)
    model = toxicity.fit_label_model(len(y), votes.T @ votes, 0.2, [0.0] * 4)
    assert model.share[0] < 0.7 and model.share[3] < 0.7 and model.share[1] > 0.9
    assert model.a[1] > 10 * model.b[1] and abs(model.a[1] - 0.4) < 0.1


@pytest.mark.parametrize("n", [1, 2, 3, 100, 4097])
def test_permutation(n):
    p = order.Permutation(n, key=7)
    slots = p.slots(np.arange(n))
    assert sorted(slots.tolist()) == list(range(n))
    assert p.numbers(slots).tolist() == list(range(n))
    assert n < 100 or slots.tolist() != order.Permutation(n, key=8).slots(np.arange(n)).tolist()


def test_shards_round_trip_and_resume(spark):
    texts = [None, "", "x", "ab" * 700, "é" * 64, "é" * 64] + [f"text {i} " * (i % 30) for i in range(300)]
    docs = spark.createDataFrame([(i if i != 4 else None, t) for i, t in enumerate(texts)], "doc_id long, text string").withColumn("slot", F.lit(1))
    shards = order.materialise(docs, length=128, per_shard=300, write_first=True)
    rows = order.read_back(spark, shards).orderBy("slot").collect()
    assert [r["slot"] for r in rows] == list(range(shards.n)) == list(range(sum(-(-len((t or "").encode()) // 128) for t in texts)))
    assert all(r["shard"] == r["slot"] // 300 and r["byte_offset"] == r["slot"] % 300 * shards.stride for r in rows)
    back = {}
    for r in sorted(rows, key=lambda r: r["seq"]):
        back.setdefault(r["id"], []).append(bytes(r["tokens"]))
    assert b"".join(back[3]).decode() == texts[3] and b"".join(back[None]).decode() == texts[4] and 0 not in back and 1 not in back
    tail = order.read_back(spark, shards, 401, 700).orderBy("slot").collect()
    assert [r["tokens_sha256"] for r in tail] == [r["tokens_sha256"] for r in rows[401:700]]
    again = order.materialise(docs, length=128, per_shard=300, write_first=True)
    assert sorted(tuple(r) for r in order.read_back(spark, again).collect()) != [] and again.n == shards.n
    empty = order.materialise(docs.limit(0), write_first=True)
    assert empty.n == 0 and order.read_back(spark, empty).count() == 0
