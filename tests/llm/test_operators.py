"""Every operator against a brute-force version, an exact round trip or held-out accuracy, on given and on odd rows."""

from __future__ import annotations

import random
import zlib
from fractions import Fraction

import brute
import numpy as np
import public_tokenizers as P
import pytest
from llm_rows import odd_rows
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from orderlens.llm import (
    bpe, common, edit_counts, exact_dedup, inner_products, language, main_text, minhash, mixing, passages, queries, token_store, units,
)
from orderlens.llm import components as component_rounds
from orderlens.llm.components import components

SF = "/root/testdata/sf0.001"
RANKS, JSON = P.path("byte_bpe_50k.tiktoken"), P.path("byte_bpe_50k.json")
ODD = odd_rows()


def ordered(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: tuple((x is None, x) for x in r))


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def given(docs):
    return [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]


# 1 and 10


def expected_store(rows):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(JSON)
    tokenizer.encode_special_tokens = True
    at, out = 0, []
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0], r[1] or "")):
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 0]
        out.append((i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return out


def test_token_store(spark, given):
    assert ordered(queries.QUERIES["op1_token_store"](spark, SF).collect()) == ordered(expected_store(given))


def test_token_store_of_odd_rows(spark, odd, tmp_path):
    token_store.write(odd, str(tmp_path / "s"), JSON, 0, literal=True)
    assert ordered(token_store.catalogue(spark, str(tmp_path / "s")).collect()) == ordered(
        expected_store([(r[0], r[1]) for r in ODD])
    )
    keys = spark.createDataFrame([(5,), (18,), (999,), (None,), (5,)], "doc_id long")
    found = token_store.lookup(token_store.read(spark, str(tmp_path / "s")), keys).collect()
    assert sorted(r.key for r in found) == [5, 18, 18]


def test_token_store_query_gives_added_tokens_their_id(spark, tmp_path):
    from tokenizers import Tokenizer

    library, end = Tokenizer.from_file(JSON), "<|endoftext|>"
    random.seed(7)
    rows = [(0, f"end {end} x"), (1, end), (2, f"  {end}  {end}{end} 's\n{end} "), (3, "plain words only")]
    rows += [(i, "".join(random.choice([end, end[:6], "a", "bc", " ", " ", "  ", "\n", "é", "\xa0", "'s", "1"]) for _ in range(60))) for i in range(4, 120)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    at, want = 0, []
    for i, t in rows:
        ids = [*library.encode(t, add_special_tokens=False).ids, 0]
        want.append((i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    assert ordered(queries.QUERIES["op1_token_store"](spark, str(tmp_path)).collect()) == ordered(want)


def test_token_store_spreads_a_key_over_parts_and_shards(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(token_store, "SHARD_IDS", 64)
    random.seed(11)
    rows = [(random.choice([None, None, 5, 5, 5, i]), f"{random.random()} word{i} and more") for i in range(600)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    token_store.write(frame, str(tmp_path / "s"), JSON, 0)
    store = token_store.read(spark, str(tmp_path / "s"))
    assert ordered(token_store.catalogue(spark, str(tmp_path / "s")).collect()) == ordered(expected_store(rows))
    assert store.where("first_key <= 5 and last_key >= 5").select("part").distinct().count() > 1
    assert store.where("first_key is null").select("part").distinct().count() > 1
    keys = spark.createDataFrame([(5,), (7000,)], "doc_id long")
    assert token_store.lookup(store, keys).count() == sum(i == 5 for i, _ in rows)


def test_empty_token_store(spark, none, tmp_path):
    token_store.write(none, str(tmp_path / "s"), JSON, 0)
    assert token_store.catalogue(spark, str(tmp_path / "s")).count() == 0


def test_perfect_hash_is_minimal():
    hashes = token_store.key_hashes(np.arange(5000), np.zeros(5000, bool))
    made = token_store.PerfectHash.from_bytes(token_store.PerfectHash.build(hashes).to_bytes())
    assert sorted(made.slots(hashes)) == list(range(5000))


def test_units_are_cut_at_marks_and_ids_stay_those_of_the_whole_text():
    library = Tokenizer.from_file(JSON)
    memo, marks = token_store._memo.__wrapped__(JSON, False)

    def check(texts):
        raw = [t.encode() for t in texts]
        ids, at = units.encode_texts(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]), memo, marks)
        for text, a, b in zip(texts, at[:-1], at[1:], strict=True):
            assert ids[a:b].tolist() == library.encode(text, add_special_tokens=False).ids, texts

    check(["a word, a word. a word! a word?", "word.\nOne word,\nword"])
    assert b" word" in memo.young and b" word," not in memo.young and b"One" in memo.young
    random.seed(5)
    parts = [*"  aabTs.,!?$&:;\n\n\t'é×÷ÿß\u00a0\u3000\u0301日1²)\"(|<>-_\r\x85\x1c", "<|endoftext|>", "'re", "'s ", " the"]
    for _ in range(3000):
        check(["".join(random.choices(parts, k=random.randint(0, 14))) for _ in range(4)])


def test_bpe_plan_has_one_python_step(odd):
    rows = bpe.digests(bpe.encoded(odd, RANKS, P.PATTERN))
    assert rows._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1


def test_bpe_encodes_as_the_library_does(spark, odd, given):
    library = edit_counts.encoder(RANKS, P.PATTERN)
    rows = bpe.encoded(odd, RANKS, P.PATTERN).collect()
    want = [(r[0], np.array(library.encode_ordinary(r[1] or ""), "<u4").tobytes(), (r[1] or "").encode()) for r in ODD]
    assert ordered((r.doc_id, bytes(r.ids), bytes(r.decoded)) for r in rows) == ordered(want)
    codec = bpe.codec(RANKS, P.PATTERN)
    random.seed(3)
    for text in ("".join(random.choice(" aab\n\t'sé日1²!\x85") for _ in range(40)) for _ in range(300)):
        pieces = [p.encode() for p in codec.split(text)]
        ids = b"".join(codec._merged(list(dict.fromkeys(pieces)))[list(dict.fromkeys(pieces)).index(p)] for p in pieces)
        assert np.frombuffer(ids, "<u4").tolist() == library.encode_ordinary(text)


# 2


def test_mix(docs, odd, none):
    rows = [r.asDict() for r in mixing.mix(docs).collect()]
    assert len(rows) == docs.count() and all(r["taken"] <= 3 * r["size"] for r in rows)
    assert ordered(mixing.mix(docs).collect()) == ordered(mixing.mix(docs).collect())
    total = sum(r["size"] for r in rows)
    targets = {r["source"]: r["target"] for r in rows}
    assert sum(targets.values()) == pytest.approx(total)
    for source, target in targets.items():
        assert sum(r["taken"] for r in rows if r["source"] == source) == pytest.approx(target, rel=0.1)
    strange = mixing.mix(odd).collect()
    assert len(strange) == len(ODD) and all(r.taken <= 3 * r["size"] for r in strange)
    assert all(r.target <= 3 * r.source_size + 1e-6 for r in strange)
    assert mixing.mix(none).count() == 0


def test_permutation_is_one(spark):
    rows = spark.range(1000).select(mixing.permuted(F.col("id"), F.lit(1000), F.lit(1)).alias("x")).collect()
    assert sorted(r.x for r in rows) == list(range(1000))


# 3


def test_exact_dedup(spark, docs, odd, none, given):
    assert ordered(exact_dedup.dedup_table(docs).collect()) == ordered(brute.exact(given))
    assert ordered(exact_dedup.dedup_table(odd).collect()) == ordered(brute.exact([(r[0], r[1]) for r in ODD]))
    assert exact_dedup.dedup_table(none).count() == 0


def test_equal_digests_of_different_texts_stay_apart(spark):
    shape = "doc_id long, digest binary, length long, points long, plain binary"
    one, other = bytearray(b"\x01" * 32), bytearray(b"\x02" * 32)
    early = spark.createDataFrame([(1, one, 3, 3, bytearray(b"abc")), (2, other, 3, 3, bytearray(b"xyz"))], shape)
    late = spark.createDataFrame([(3, one, 3, 3, bytearray(b"abd")), (4, other, 3, 4, bytearray(b"xyz"))], shape)
    got = exact_dedup.dedup(late, exact_dedup.snapshot(early), early).collect()
    assert {r.doc_id: (r.keep_id, r.group_size, r.kept) for r in got} == {
        1: (1, 1, True), 3: (3, 1, True), 2: (4, 2, False), 4: (4, 2, True),
    }


def test_exact_dedup_with_many_filters_and_parts(spark, docs, given):
    rows = exact_dedup.digested(docs)
    early, late = rows.where("doc_id % 3 = 0"), rows.where("doc_id % 3 <> 0")
    frozen = exact_dedup.snapshot(early, filter_keys=8)
    assert frozen.buckets > 3
    assert ordered(exact_dedup.dedup(late, frozen, early).collect()) == ordered(brute.exact(given))


def test_filter_finds_all_and_few_others():
    keys = np.arange(1, 20_001, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    made = exact_dedup.BinaryFuse.build(keys)
    assert made.find(keys).all()
    assert made.find(keys + np.uint64(1)).mean() < 0.01
    for n in (0, 1, 2, 3, 100):
        assert exact_dedup.BinaryFuse.build(keys[:n]).find(keys[:n]).all()


# 4


def test_language(spark, odd, none):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = language.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert np.mean([r.lang == r.lang_pred for r in rows]) > 0.98
    found = {r.doc_id: r for r in language.identify(odd).collect()}
    assert all(found[i].lang_pred == "und" and found[i].score == 0 for i in (1, 2, 3, 4))
    assert all(0 <= r.score <= 1 for r in found.values())
    assert language.identify(none).count() == 0


def test_long_texts_count_the_same_in_pieces(monkeypatch):
    text = "Über den Dächern, of the old town 12 x " * 200
    whole = language.counted([text])
    monkeypatch.setattr(language, "SLICE_CHARS", 100)
    assert all((a == b).all() for a, b in zip(whole, language.counted([text]), strict=True))


# 5


def test_passages(docs, odd, none, given):
    assert ordered(passages.without_repeats(docs).collect()) == ordered(brute.passages(given))
    assert ordered(passages.without_repeats(odd).collect()) == ordered(brute.passages([(r[0], r[1]) for r in ODD]))
    assert passages.without_repeats(none).count() == 0


# 6


def test_main_text(spark):
    page = (
        "<html><head><title>T</title></head><body><header><h1>Site</h1></header><div id=cookie-notice>We use cookies, ok.</div>"
        "<div class=main-menu><ul><li><a href=x>Home</a><li><a>About</a></ul></div><div class=content>"
        "<div class='left sidebar'>Side stuff that is long, long, long enough.</div><div class=post><h2>A &amp; B</h2>"
        "<p>First   paragraph, with commas &#233;&eacute;, enough to count.<p>Second <a href=x>link</a>, goes on, and on.<br>"
        "<ul><li>One<li>Two</ul><form>name <input></form><script>var x='<p>no';</script></div>"
        "<div class=comments><p>I think, therefore, this is a comment, long.</p></div></div><footer>&copy;</footer>"
    )
    want = "A & B\nFirst paragraph, with commas éé, enough to count.\nSecond link, goes on, and on.\nOne\nTwo"
    rows = [(1, "u", page), (2, None, None), (3, "u", ""), (4, "u", "<div><div>"), (None, "u", "<p>a<b>b<p>c</i></p><p"), (1, "u", page)]
    found = main_text.extracted(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert ordered((r.page_id, r.text, r.n_chars) for r in found) == ordered(
        [(1, want, len(want)), (2, "", 0), (3, "", 0), (4, "", 0), (None, "ab\nc", 4), (1, want, len(want))]
    )
    pages = queries.QUERIES["op6_main_text"](spark, SF)
    assert pages.where("n_chars = 0").count() == 0


def test_main_text_is_not_lost_to_class_words():
    p = "<p>A paragraph, with commas, long enough to count for the page.</p>"
    want = "A paragraph, with commas, long enough to count for the page."
    side = "<div class=sidebar><p>Side stuff, which is long, but is not the text.</p></div>"
    for names in ("content has-sidebar", "article no-comments", "layout-with-header", "ad-free", "main widget"):
        wrapped = f"<div>1 May 2020</div><div class='{names}'>{p * 3}{side}</div>"
        assert main_text.main_text(wrapped) == "\n".join([want] * 3), names
    article = f"<div>1 May 2020</div><div class='page sidebar'><article>{p * 2}</article></div>"
    assert main_text.main_text(article) == "\n".join([want] * 2)
    parts = (
        f"<article><div class='post-header'><h1>Title</h1></div><div class=byline>By A</div>{p}<ul><li><a href=x>One</a>"
        "<li><a href=y>Two</a></ul><div class=tags>Red</div><div class=disclaimer>No advice</div>"
        "<div class=related-links><ul><li><a href=z>More</a></ul></div></article>"
    )
    assert main_text.main_text(parts) == f"Title\nBy A\n{want}\nOne\nTwo\nRed\nNo advice"
    remarks = "<div class=comments>" + "".join(f"<article>{p.replace('A', 'My')}</article>" for _ in range(4)) + "</div>"
    assert main_text.main_text(f"<div class=text>{p * 3}</div>{remarks}") == "\n".join([want] * 3)


# 7


def test_top_k(spark):
    nan, inf = float("nan"), float("inf")
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(size=5).astype(np.float32).tolist()) for i in range(400)]
    rows += [(500, None), (600, [nan] * 5), (700, [inf, 1.0, 1.0, 1.0, 1.0]), (800, [None, 1.0, 1.0, 1.0, 1.0]), (900, []), (1000, [1.0, 2.0]), (7, rows[7][1])]
    rows[100] = (100, rows[7][1])
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = inner_products.top_k(frame, F.col("vec_id") % 100 == 0).collect()
    good = [(i, np.floor(1024 * np.array(v, float))) for i, v in rows if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    want = []
    for q, v in good:
        if q % 100 == 0:
            scores = sorted({(-int(v @ w), i) for i, w in good if i != q and len(w) == len(v)})[:10]
            want += [(q, k + 1, i, -s) for k, (s, i) in enumerate(scores)]
    assert ordered(got) == ordered(want)
    assert inner_products.top_k(frame.where("false"), F.col("vec_id") % 100 == 0).count() == 0


def best_products(rows, k=10):
    """Distinct pairs of score and id of each query id, best first."""
    good = [(i, np.floor(1024 * np.array(v, float))) for i, v in rows]
    found = {}
    for q, v in good:
        if q % 100 == 0:
            found.setdefault(q, set()).update((-int(v @ w), i) for i, w in good if i != q)
    return [(q, n + 1, i, -s) for q, pairs in found.items() for n, (s, i) in enumerate(sorted(pairs)[:k])]


def test_top_k_counts_copies_once(spark):
    rng = np.random.default_rng(6)
    base = [(i, rng.normal(size=5).astype(np.float32).tolist()) for i in range(1500)]
    queries_twice = base + [r for r in base if r[0] % 100 == 0]
    longest = max((r for r in base if r[0] % 100), key=lambda r: np.linalg.norm(r[1]))
    copies = base + [longest] * 11
    # Vectors of one id that differ but score alike against a query that is zero where they differ.
    alike = [(i, [*r[:4], 0.0]) if i % 100 == 0 else (i, r) for i, r in base] + [(2001, [*longest[1][:4], float(j)]) for j in range(12)]
    two_vectors = base + [(100, base[7][1]), (100, base[8][1])]
    for rows in (queries_twice, copies, alike, two_vectors):
        frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)
        assert ordered(inner_products.top_k(frame, F.col("vec_id") % 100 == 0).collect()) == ordered(best_products(rows))


# 8


def test_edits(spark, odd, monkeypatch):
    library = edit_counts.encoder(RANKS, P.PATTERN)
    count = lambda t: len(library.encode_ordinary(t))
    random.seed(2)
    for _ in range(150):
        text = "".join(random.choice("ab c  d\n.é ") for _ in range(random.randint(0, 400)))
        monkeypatch.setattr(edit_counts, "LEAF_UNITS", random.choice([1, 3, 10]))
        monkeypatch.setattr(edit_counts, "LONG_LEAF", random.choice([10, 50, 4000]))
        leaves = edit_counts.cut(text)
        tree = edit_counts.CountTree(leaves, [count(x) for x in leaves], count)
        for _ in range(6):
            at, removed = random.randint(0, len(text) + 2), random.choice([0, 1, 5, 500])
            inserted = "".join(random.choice("ab c\n ") for _ in range(random.choice([0, 1, 3, 30])))
            tree.edit(at, removed, inserted)
            at = min(at, len(text))
            text = text[:at] + inserted + text[at + removed :]
            assert (tree.text(), tree.n_chars, tree.n_tokens) == (text, len(text), count(text))
    edits = edit_counts.revision(F.col("doc_id"), F.col("text"), F.col("source"))
    stored = edit_counts.trees(odd.withColumn("edits", edits), RANKS, P.PATTERN, edits="edits")
    rows = edit_counts.counted(stored, RANKS, P.PATTERN, keep_text=True).collect()
    assert len(rows) == len(ODD)
    assert all(r.n_tokens_after == count(r.text_after) and r.n_chars_after == len(r.text_after) for r in rows)
    assert sum(r.n_tokens_before for r in rows) == sum(count(r[1] or "") for r in ODD)
    later = spark.createDataFrame([(5, 2, 0, 0, "B"), (5, 1, 0, 3, "A")], "doc_id long, seq int, at long, removed long, inserted string")
    five = edit_counts.counted(edit_counts.with_edits(stored, later), RANKS, P.PATTERN, keep_text=True).where("doc_id = 5").first()
    assert five.text_after.startswith("BA quick") and five.n_edits == 2


# 9


def test_near_duplicates(docs, odd, none, given):
    found = minhash.near_duplicates(docs, shingle=3, threshold=Fraction(85, 100)).collect()
    assert ordered(found) == ordered(brute.near(given, 3, 85, 100))
    single = [(r[0], r[1]) for r in ODD if r[0] not in (None, 18)]
    got = [r for r in minhash.near_duplicates(odd).collect() if r.doc_id not in (None, 18)]
    assert ordered(got) == ordered(brute.near(single, 5, 4, 5))
    assert minhash.near_duplicates(none).count() == 0


def test_large_clusters_are_cut_into_blocks(spark, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK_DOCS", 7)
    random.seed(4)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(60):
        words = list(base)
        for _ in range(random.randint(0, 6)):
            words[random.randrange(len(words))] = f"x{random.randrange(50)}"
        rows.append((i, " ".join(words[: random.randint(105, 120)])))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert ordered(minhash.near_duplicates(frame, shingle=3, threshold=Fraction(85, 100)).collect()) == ordered(brute.near(rows, 3, 85, 100))


def test_groups_of_one_cluster_meet_in_rounds(spark, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK_DOCS", 5)
    monkeypatch.setattr(minhash, "PIVOTS", 1)
    random.seed(9)
    base = [f"w{i}" for i in range(150)]
    bases = [base, base[:95] + [f"y{i}" for i in range(45)], base[:8] + [f"z{i}" for i in range(60)] + base[20:90]]
    rows = []
    for i in range(120):
        words = list(random.choice([*bases, base]))
        for _ in range(random.choice([0, 1, 3, 5, 9, 14])):
            words[random.randrange(len(words))] = f"x{random.randrange(40)}"
        rows.append((i, " ".join(words[: random.randint(len(words) - 30, len(words))])))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = minhash.near_duplicates(frame, shingle=2, threshold=Fraction(7, 10)).collect()
    want = brute.near(rows, 2, 7, 10)
    assert ordered(got) == ordered(want)
    assert 3 < len({r[2] for r in want}) < 80


def test_components(spark):
    links = [(i, i + 1) for i in range(100)] + [(200, 300), (300, 250), (7, 7), (None, 3)]
    got = components(spark.createDataFrame(links, "a long, b long")).collect()
    assert {r.node: r.component for r in got} == {**{i: 0 for i in range(101)}, 200: 200, 300: 200, 250: 200}


def counts_staged(monkeypatch):
    """Names of the tables that near-duplicate groups and components stage from now on."""
    names = []
    for module in (minhash, component_rounds):
        monkeypatch.setattr(module, "staged", lambda df, name, run=common.staged: names.append(name) or run(df, name))
    return names


def test_components_write_two_tables_a_round(spark, monkeypatch):
    random.seed(5)
    names = counts_staged(monkeypatch)
    stars = [(i, i - i % 50) for i in range(500)]
    got = components(spark.createDataFrame(stars, "a long, b long")).collect()
    # Stars need no round.
    assert {r.node: r.component for r in got} == {i: i - i % 50 for i in range(500)} and names == ["links", "nodes"]
    names.clear()
    ids = random.sample(range(1000, 2000), 300)
    zigzag = [x for i in range(100) for x in (3000 + i, 3999 - i)]
    chains = [*zip(ids, ids[1:]), *zip(zigzag, zigzag[1:]), *zip(range(5000, 5200), range(5001, 5200))]
    hub = [(9999, i) for i in range(9000, 9200)]
    links = [*chains, *hub, *((random.randrange(400), random.randrange(400)) for _ in range(350))]
    got = components(spark.createDataFrame(links, "a long, b long")).collect()
    lows = {x: x for link in links for x in link if link[0] != link[1]}
    for _ in range(300):
        for a, b in links:
            if a != b:
                lows[a] = lows[b] = min(lows[a], lows[b])
    assert {r.node: r.component for r in got} == lows and len(got) == len(lows)
    # At most ten rounds for chains of 300 nodes.
    assert len(names) <= 22


def test_small_clusters_take_no_rounds_after_they_are_confirmed(spark, monkeypatch):
    """Rows of one id join groups of two clusters; else the groups of clusters that one task compares are final."""
    names = counts_staged(monkeypatch)
    a, b = [f"a{i}" for i in range(60)], [f"b{i}" for i in range(60)]
    rows = [(1, a), (2, [*a, "x"]), (3, b), (4, [*b, "x"]), (8, [*a, "y"])]
    alone = spark.createDataFrame([(i, " ".join(w)) for i, w in rows], "doc_id long, text string")
    got = minhash.near_duplicates(alone, shingle=3, threshold=Fraction(85, 100)).collect()
    assert {r.doc_id: r.component_id for r in got} == {1: 1, 2: 1, 8: 1, 3: 3, 4: 3}
    # Candidate clusters take a round at most; groups one look at no links.
    assert len(names) <= 15 and names[-3:] == ["groups", "links", "nodes"]
    both = spark.createDataFrame([(i, " ".join(w)) for i, w in [*rows, (5, [*a, "x"]), (5, [*b, "x"])]], "doc_id long, text string")
    got = minhash.near_duplicates(both, shingle=3, threshold=Fraction(85, 100)).collect()
    assert {r.doc_id: r.component_id for r in got} == dict.fromkeys((1, 2, 3, 4, 5, 8), 1) and len(got) == 7


# the pipeline


def test_pipeline(spark, docs, given):
    columns = docs.columns
    frame, sizes = docs, [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:3]:
        frame = stage(spark, frame, SF)
        assert frame.columns == columns, name
        sizes.append(frame.count())
    kept = {i for i, *_, keep, _ in brute.exact(given) if keep}
    rest = [r for r in given if r[0] in kept]
    want = {i for i, _, _, keep in brute.near(rest, 5, 4, 5) if keep}
    assert {r.doc_id for r in frame.select("doc_id").collect()} == want
    done = corpus_pipeline.run(spark, SF)
    library = edit_counts.encoder(RANKS, P.PATTERN)
    texts = dict(given)
    rows = done.collect()
    assert rows and {r.doc_id for r in rows} <= want
    assert all(r.n_tokens == len(library.encode_ordinary(texts[r.doc_id])) for r in rows)


def test_pipeline_takes_odd_and_empty_tables(spark, odd, none):
    for frame in (odd, none):
        columns = frame.columns
        for name, stage in corpus_pipeline.STAGES:
            frame = stage(spark, frame, SF)
            assert name == "bpe" or frame.columns == columns
        frame.count()


def test_pipeline_dedups_rows_with_null_and_repeated_ids(spark):
    words = lambda start, n=40: " ".join(f"w{start + i}" for i in range(n))
    rows = [
        (1, words(0)), (None, words(0)), (None, words(100)), (None, words(100)), (None, words(200)), (None, "   "), (2, ""),
        (3, words(300)), (3, words(300)), (3, words(300)), (4, words(400)), (4, words(0)), (5, words(500) + " x"),
        (6, words(500) + " y"), (6, words(600)), (7, words(700)), (7, words(700).replace(" ", "\t")),
        (None, words(500) + " z"), (8, None),
    ]
    frame = spark.createDataFrame([(i, t, "en", "a", 0) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    frame = frame.repartition(4)
    once = corpus_pipeline.drop_exact_copies(spark, frame, SF)
    assert once.columns == frame.columns
    once = [(r.doc_id, r.text) for r in once.collect()]
    assert sorted(brute.bare(t) for _, t in once) == sorted({brute.bare(t) for _, t in rows})
    # The longest text stays, then the smallest id; null loses.
    best = {}
    for i, t in rows:
        best[brute.bare(t)] = min(best.get(brute.bare(t), (0, True, 0)), (-len(t or ""), i is None, i or 0))
    assert all((-len(t or ""), i is None, i or 0) == best[brute.bare(t)] for i, t in once)
    near = [(r.doc_id, r.text) for r in corpus_pipeline.drop_near_copies(spark, frame.where("doc_id is null or doc_id > 2"), SF).collect()]
    named = [(i, t) for i, t in near if i is not None]
    assert ordered((i, brute.bare(t)) for i, t in named) == ordered(
        (i, brute.bare(t)) for i, t in [(3, words(300)), (4, words(400)), (4, words(0)), (5, words(500) + " x"), (6, words(600)), (7, words(700)), (8, None)]
    )
    assert sum(i is None for i, _ in near) == sum(i is None for i, _ in rows)


# Words and sequences that collide under a polynomial modulo 2**64, whatever its base.


def thue_morse(n, zero, one):
    return [one if bin(i).count("1") & 1 else zero for i in range(n)]


def colliding_rows():
    a, b = "".join(thue_morse(2048, "a", "b")), "".join(thue_morse(2048, "b", "a"))
    some = " ".join(f"w{i}" for i in range(49))
    x, y = " ".join(thue_morse(2048, "ab", "ba")), " ".join(thue_morse(2048, "ba", "ab"))
    return [(1, f"{some} {a}"), (2, f"{some} {b}"), (3, f"{a} x y"), (4, f"{b} x y"), (5, x), (6, y), (7, f"{some} {a}"), (8, f"{x} {y}")]


def test_times_of_the_prime_field():
    from orderlens.llm import common

    random.seed(1)
    edge = [0, 1, common.PRIME - 1, (1 << 31) - 1, 1 << 31, (1 << 60) + 1]
    a = [*edge, *(random.randrange(common.PRIME) for _ in range(500))]
    b = [*edge[::-1], *(random.randrange(common.PRIME) for _ in range(500))]
    assert common.times(np.array(a, np.uint64), np.array(b, np.uint64)).tolist() == [x * y % common.PRIME for x, y in zip(a, b, strict=True)]
    values = np.array([random.randrange(1 << 64) for _ in range(3000)], np.uint64)
    prefix, want = common.prefix_hashes(values, common.OTHER_BASE), 0
    for i, v in enumerate(values.tolist()):
        want = (want + v * pow(common.OTHER_BASE, i, common.PRIME)) % common.PRIME
        assert int(prefix[i + 1]) == want


def test_words_that_share_a_polynomial_hash_stay_apart(spark):
    rows = colliding_rows()
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert ordered(passages.without_repeats(frame).collect()) == ordered(brute.passages(rows))
    found = minhash.near_duplicates(frame, shingle=3, threshold=Fraction(85, 100)).collect()
    assert ordered(found) == ordered(brute.near(rows, 3, 85, 100))


def test_rows_that_repeat_an_id_keep_their_own_passages(spark):
    p = " ".join(f"p{i}" for i in range(60))
    rows = [(1, p), (2, f"{p} a"), (2, f"b {p}"), (2, "short"), (None, p), (None, f"{p} z"), (3, p), (3, p)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert ordered(passages.without_repeats(frame).collect()) == ordered(brute.passages(rows))


def test_pipeline_leaves_columns_of_any_name_alone(spark, docs):
    names = ["_row", "_tie", "_found", "_copy", "_id", "_times", "_group", "_best", "__row", "_ROW ", "a.b", "size", "block", "taken", "n", "rows"]
    frame = docs.where("doc_id < 60").select("*", *[F.concat(F.lit(f"{n}:"), F.col("doc_id")).alias(n) for n in names])
    for _, stage in corpus_pipeline.STAGES[:4]:
        frame = stage(spark, frame, SF)
    rows = frame.collect()
    assert rows and frame.columns == [*docs.columns, *names]
    assert all(r[n] == f"{n}:{r.doc_id}" for r in rows for n in names)


def test_pipeline_mix_takes_rows_without_an_id_by_themselves(spark):
    rows = [(None, " ".join(f"n{i} w{j}" for j in range(15)), "en", "a", 0) for i in range(200)]
    rows += [(7, " ".join(f"s{i} w{j}" for j in range(15)), "en", "a", 0) for i in range(200)]
    rows += [(100 + i, " ".join(f"b{i} w{j}" for j in range(15)), "en", "b", 0) for i in range(400)]
    frame = spark.createDataFrame(rows, DOCS_OF_PIPELINE).repartition(3)
    taken = {r.id: r.taken for r in mixing.mix(frame).groupBy(F.coalesce("doc_id", F.lit(-1)).alias("id")).agg(F.sum("taken").alias("taken")).collect()}
    out = corpus_pipeline.mix_sources(spark, frame, SF).groupBy("doc_id").agg((F.count("*") * 30).alias("words")).collect()
    words = {-1 if r.doc_id is None else r.doc_id: r.words for r in out}
    assert words[-1] == pytest.approx(taken[-1], rel=0.15) and words[7] == pytest.approx(taken[7], rel=0.15)
    assert sum(words.values()) == pytest.approx(sum(taken.values()), rel=0.1)


DOCS_OF_PIPELINE = "doc_id long, text string, lang string, source string, n_chars long"


def test_blocks_of_vectors_are_left_out_only_where_no_hit_can_be(spark, monkeypatch):
    monkeypatch.setattr(inner_products, "BLOCK", 16)
    monkeypatch.setattr(inner_products, "QUERY_BLOCK", 4)
    rng = np.random.default_rng(4)
    # Lengths from tiny to large, so that most blocks of short vectors cannot hold a hit.
    some = rng.normal(size=(1500, 6)) * 10.0 ** rng.uniform(-3, 1, size=(1500, 1))
    rows = [(i, v.tolist()) for i, v in enumerate(some)] + [(i, v.tolist()) for i, v in enumerate(some[:40])]
    rows += [(2000 + i, [0.0] * 6) for i in range(12)] + [(3000, [1.0, 2.0]), (3100, [2.0, 1.0]), (3200, None), (3300, [float("nan")] * 6)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 as dim", "2 as part", "3 as q", "4 as least").repartition(5)
    found = inner_products.top_k(frame, F.col("vec_id") % 100 == 0).collect()
    whole = {(i, tuple(np.floor(1024 * np.array(v)))) for i, v in rows if v is not None and np.isfinite(v).all()}
    want = []
    for q, x in sorted(whole):
        if q % 100 == 0:
            scores = sorted((-int(np.dot(x, y)), c) for c, y in whole if c != q and len(y) == len(x))
            want += [(q, k + 1, c, -s) for k, (s, c) in enumerate(scores[:10])]
    assert ordered(found) == ordered(want)
