"""Token alignment and the prefix trie against brute force, on given and on odd rows; the toxicity score on held-out rows."""

from __future__ import annotations

import random

import brute_new
import numpy as np
import public_tokenizers as P
import pytest
from llm_rows import odd_rows
from pyspark.sql import functions as F

from orderlens.llm import alignment, prefix_trie, queries, toxicity

SF = "/root/testdata/sf0.001"
A, B = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")
ALIGNED = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
NODE = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
TURNS = "conv_id long, turn long, role string, text string"


def ordered(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: tuple((x is None, x) for x in r))


# 11


def tokenisers():
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=B)
    known = alignment.aligner(A, B)
    return (
        lambda t: [(i, known.a_bytes[i]) for i in a.encode(" " + t, add_special_tokens=False).ids],
        lambda t: [(i, known.b_bytes[i]) for i in b.encode(t)],
    )


@pytest.mark.parametrize("hot_pairs", [alignment.HOT_PAIRS, 50, 0])
def test_alignment(spark, hot_pairs):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("octet_length(text) < 6000 or text is null")
    given = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    found = alignment.aligned(docs, A, B, hot_pairs=hot_pairs).collect()
    assert ordered(tuple(r[c] for c in ALIGNED) for r in found) == ordered(brute_new.alignment(given, *tokenisers()))


def test_alignment_of_odd_rows(spark, odd, none):
    rows = [(r[0], r[1]) for r in odd_rows() if len(r[1] or "") < 10_000]
    rows += [(100, "a ▁ b"), (101, "a  b\x00 ▁"), (102, "<s> </s> <unk> <0x41><|endoftext|>"), (103, "👍🏽 日本 é́ 　 x\r\n\r\n  y")] * 2
    random.seed(5)
    some = [" ", "  ", "a", "th", "é", "日", "\n", "\xa0", "<s>", "x1", "👍", "'s", "　", "\x85", "▁"]
    rows += [(200 + i, "".join(random.choices(some, [9] * 14 + [0.2], k=40))) for i in range(60)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as n", "2 as pair", "3 as sha", "4 as copies")
    found = alignment.aligned(frame, A, B, hot_pairs=30).collect()
    assert ordered(tuple(r[c] for c in ALIGNED) for r in found) == ordered(brute_new.alignment(rows, *tokenisers()))
    assert alignment.aligned(odd, A, B).count() == odd.count()
    assert alignment.aligned(none, A, B).count() == 0


def test_units_are_remembered_in_generations(spark, monkeypatch):
    known = alignment.Aligner(A, B)
    known.memo.entries = 20
    text = "one two three four five six seven eight nine ten eleven twelve " * 3
    wide = alignment.aligner(A, B)
    data = np.frombuffer(text.encode(), np.uint8)
    for _ in range(3):
        for x, y in zip(known.texts(data, np.array([0, len(data)])), wide.texts(data, np.array([0, len(data)])), strict=True):
            assert np.array_equal(x, y)


# 12


def test_trie(spark):
    for path in (SF, "/root/testdata/sf0.01"):
        rows = [tuple(r) for r in spark.read.parquet(f"{path}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
        found = queries.QUERIES["op12_prefix_trie"](spark, path).collect()
        assert ordered(tuple(r[c] for c in NODE) for r in found) == ordered(brute_new.trie(rows))


def test_trie_of_odd_rows(spark, monkeypatch):
    random.seed(11)
    for case in range(6):
        # Few different turns, so that prefixes branch, repeat and end inside others; very small partitions.
        monkeypatch.setattr(prefix_trie, "PART_ROWS", random.choice([1, 3, 10]))
        monkeypatch.setattr(prefix_trie, "BLOCK_BYTES", 8)
        rows = []
        for c in random.sample(range(-30, 120), 70):
            for t in range(random.choice([1, 2, 3, 4, 12, 14])):
                rows.append((c, t - 1 if t else None, random.choice(["user", None, ""]), random.choice(["a", "é", None] if case < 5 else ["a"])))
        rows += [(None, 0, "user", "no conversation")] * 3
        frame = spark.createDataFrame(rows, TURNS).selectExpr("*", "1 as part", "2 as node", "3 as base", "4 as h").repartition(3)
        found = prefix_trie.trie(frame).collect()
        assert ordered(tuple(r[c] for c in NODE) for r in found) == ordered(brute_new.trie(rows)), case


def test_trie_of_turnless_and_single_conversations(spark):
    # 1 borrows more turns than there are and keeps none of its own; 5's borrowed ones are its own.
    for rows in ([(7, 0, "u", "x")], [(c, 0, "u", "same") for c in range(40)], [(5, 0, None, None), (5, 1, "u", "y" * 100_000)]):
        found = prefix_trie.trie(spark.createDataFrame(rows, TURNS)).collect()
        assert ordered(tuple(r[c] for c in NODE) for r in found) == ordered(brute_new.trie(rows))
    assert prefix_trie.trie(spark.createDataFrame([], TURNS)).count() == 0


def test_equal_turns_of_a_conversation_are_all_kept(spark):
    frame = spark.createDataFrame([(5, 0, "u", "x"), (5, 0, "u", "x"), (5, 0, "u", "y")], TURNS)
    assert prefix_trie.trie(frame).agg(F.max("depth")).first()[0] == 3


# 13


def plain_kernel(s, t):
    def sums(x):
        out = {}
        for i in range(len(x)):
            for j in range(i + 1, len(x)):
                for k in range(j + 1, min(len(x), i + toxicity.SPAN)):
                    out[x[i] + x[j] + x[k]] = out.get(x[i] + x[j] + x[k], 0) + toxicity.DECAY ** (k - i + 1)
        return out

    a, b = sums(s), sums(t)
    # A length counts every place of a subsequence for itself.
    norm = [sum(toxicity.DECAY ** (2 * (k - i + 1)) for i in range(len(x)) for k in range(i + 2, min(len(x), i + toxicity.SPAN)) for _ in range(i + 1, k)) for x in (s, t)]
    return sum(v * b.get(u, 0) for u, v in a.items()) / np.sqrt(max(norm[0], toxicity.DECAY**6) * max(norm[1], toxicity.DECAY**6))


def test_kernel_is_the_plain_one():
    marks, units = ["idiot", "ab", "banana", "éclair"], ["idiot", "idxiot", "iidioott", "", "nab", "an éclair".replace(" ", ""), "zzz"]
    found = toxicity.points_of(units, toxicity.landmark_table(marks))
    assert np.allclose(found, [[plain_kernel(u, m) for m in marks] for u in units])


def test_units():
    def units(*texts):
        letters, offsets, row = toxicity.units_of(list(texts))
        raw = letters.astype("<u4").tobytes().decode("utf-32-le")
        return [(int(r), raw[a:b]) for r, a, b in zip(row, offsets[:-1], offsets[1:], strict=True)]

    assert units("You i.d-i*o!t,", "", "I d i ot 12 ÉTÉ", "i", "i") == [
        (r, f"\x01{u}\x02") for r, u in ((0, "you"), (0, "idiot"), (2, "idi"), (2, "ot"), (2, "été"), (3, "i"), (4, "i"))
    ]
    long = "\x01" + "".join(chr(97 + i % 26) for i in range(58)) + "\x02"
    assert units(long[1:-1]) == [(0, long[0:24]), (0, long[12:36]), (0, long[24:48]), (0, long[36:60])]
    assert units() == units("") == []


def test_margin_of_a_document_is_that_of_its_worst_unit(monkeypatch):
    words = [f"\x01{w}\x02" for w in ("idiot", "clown", "table", "tree", "house")]
    known = toxicity.machine(words, words, np.array([1.0, 1, -1, -1, -1]), np.ones(5))
    texts = ["a table and a tree", "an id.iot in the house", None, "", "a b c", "clown " * 40]
    plain = [max([known.bias, *(known.margins(*toxicity.packed([f"\x01{w}\x02"]))[0] for w in (t or "").replace(".", "").split())]) for t in texts]
    memo = toxicity.Memo(known.encoded, 3)
    assert np.allclose(known.documents(texts, memo)[[0, 1, 2, 3, 5]], np.array(plain)[[0, 1, 2, 3, 5]])
    monkeypatch.setattr(toxicity, "SLICE_CHARS", 5)
    monkeypatch.setattr(toxicity, "PIECE_CHARS", 20)
    assert np.allclose(known.documents(texts, memo)[[0, 1, 2, 3, 5]], np.array(plain)[[0, 1, 2, 3, 5]])
    margins = known.documents(["idiot", "idxiot", "i d i o t", "table"], memo)
    assert margins[2] == margins[0] > margins[1] > margins[3]


def test_toxicity_of_held_out_documents(spark):
    rows = queries.QUERIES["op13_toxicity"](spark, "/root/testdata/sf0.1")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet").where("toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    found = rows.join(labels, "doc_id").where("held_out").collect()
    assert len(found) > 300 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in found)
    # About a quarter of the toxic documents of this table hold no word that others of them hold.
    assert np.mean([r.predicted == r.toxic for r in found]) > 0.95
    assert np.mean([r.predicted for r in found if r.toxic]) > 0.7
    insults = ["idiot", "moron", "clown", "scum", "pathetic", "disgusting", "trash", "worthless", "loser", "stupid"]
    texts = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", F.lower("text").alias("text"))
    named = rows.join(texts, "doc_id").where("held_out").where(F.regexp_like("text", F.lit(r"\b(" + "|".join(insults) + r")\b")))
    assert named.agg(F.avg("predicted")).first()[0] > 0.9


def test_toxicity_learns_inserted_characters_and_takes_odd_rows(spark, odd, none):
    random.seed(2)
    words = ["house", "tree", "river", "winter", "table", "garden", "window", "letter", "morning", "evening", "paper", "stone", "colour"]
    docs, labels = [], []
    for i in range(600):
        text = random.choices(words, k=12)
        if i % 4 == 0:
            text[random.randrange(12)] = random.choice(["dolt", "nitwit", "blockhead"])
        docs.append((i, " ".join(text)))
        labels.append((i, int(i % 4 == 0), "x"))
    labels += [(None, 1, "x"), (5, None, "x"), (7, 3, "x"), (3, 0, "y"), (3, 0, "y"), (10**6, 1, "y")]
    marked = spark.createDataFrame(labels, "doc_id long, toxic int, text string")
    probes = {1000: "the river and a nitxwit there", 1001: "a b l o c k h e a d in winter", 1002: "a n.i.t.w.i.t", 1003: "the river in winter", 1004: "", 1005: None}
    frame = spark.createDataFrame(docs + list(probes.items()), "doc_id long, text string").selectExpr("*", "1 as toxic", "'s' as score", "2 as m", "3 as unit")
    found = {r.doc_id: r for r in toxicity.scored(frame, marked).collect()}
    assert len(found) == 606 and all(found[i].predicted == (i % 4 == 0) for i in range(600))
    assert [found[i].predicted for i in range(1000, 1006)] == [1, 1, 1, 0, 0, 0]
    assert found[1004].score == found[1005].score < 0.1
    both = odd.select("doc_id", "text", F.lit("k").alias("row"))
    assert toxicity.scored(both, marked.selectExpr("doc_id % 20 as doc_id", "toxic")).count() == odd.count()
    assert toxicity.scored(none, marked).count() == 0
    empty = toxicity.scored(odd, marked.where("false"))
    assert empty.where("score = 0 and predicted = 0").count() == odd.count()
