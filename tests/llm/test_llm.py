"""Operators for training data: brute-force comparisons, edge cases and held-out accuracy."""

import collections
import hashlib
import random
import re
import time
import zlib

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gridloom.llm import bytescan, chat, components, decontaminate, eliasfano, entries, htmlmodel, htmltree, langid, metricjoin, mixing, neardup, pagetext, suffixdedup, tokens

from ..compare import check, connect

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = "the of a river stone house green tall slow bird walks over bridge night day light cold warm hand sees".split()


def make(spark, rows):
    """rows: (doc_id, text); two extra columns with names that operators use inside."""
    full = [(i, t, "en", "s", 1, "x", 7) for i, t in rows]
    return spark.createDataFrame(full, DOCS + ", sig string, mix_size int")


def sentence(rng, n):
    return " ".join(rng.choice(WORDS) + str(rng.randrange(50)) for _ in range(n))


@pytest.mark.parametrize("name", sorted(entries.SQL))
def test_matches_sql(spark, sf, name):
    check(entries.QUERIES[name](spark, sf), connect(sf), entries.SQL[name])


@pytest.mark.parametrize("name", sorted(entries.QUERIES))
def test_empty_tables(spark, sf, tmp_path, name):
    for t in ("documents", "benchmark", "embeddings", "pages", "conversations"):
        spark.read.parquet(f"{sf}/{t}.parquet").limit(0).write.parquet(f"{tmp_path}/{t}.parquet")
    n = entries.QUERIES[name](spark, str(tmp_path)).count()
    assert n == (1 if name.startswith("op3") else 0)


# --- mixing -------------------------------------------------------------------------------


def test_targets_share_and_ceiling(spark):
    rows = [("a", 10, 5.0), ("b", 1000, 2.0), ("c", 100, 1.0), (None, 50, 5.0)]
    t = {r.source: r.target for r in mixing.targets(spark.createDataFrame(rows, "source string, source_size long, weight double")).collect()}
    assert t["a"] == 30 and t[None] == 150  # both at their ceiling
    assert t["b"] == pytest.approx((1160 - 180) * 2 / 3) and t["c"] == pytest.approx((1160 - 180) / 3) or t["c"] == 300
    assert sum(t.values()) == pytest.approx(1160)


def test_mix_edges(spark):
    rows = [(1, "a b c", "s"), (1, "a b c", "s"), (2, None, None), (None, "", "s"), (3, "x " * 50_000, "t")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("mix_size", F.lit("clash"))
    m = mixing.mix(df).collect()
    assert len(m) == 5 and {r.mix_size for r in m} == {3, 0, 50_000}
    assert all(0 <= r.mix_copies <= 3 for r in m)
    same = [r.mix_copies for r in m if r.doc_id == 1]
    assert same[0] == same[1]
    out = mixing.mixed_corpus(df)
    assert out.columns == df.columns and out.count() == sum(r.mix_copies for r in m)


def test_null_ids_draw_as_in_sql(spark, tmp_path):
    rows = [(None if i % 3 == 0 else i // 2, f"w{i} " * (i % 7), ["a", "b", None, "a", "a"][i % 5]) for i in range(90)] + [(None, None, None)]
    spark.createDataFrame(rows, "doc_id long, text string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    check(mixing.op1(spark.read.parquet(f"{tmp_path}/documents.parquet")), con, mixing.OP1_SQL)


def test_mix_comes_near_targets(spark):
    rng = random.Random(5)
    rows = [(i, "w " * rng.randrange(1, 9), f"s{i % 4}") for i in range(4000)]
    m = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    for r in m.groupBy("source").agg(F.sum(F.col("mix_size") * F.col("mix_copies")).alias("k"), F.max("mix_target").alias("t")).collect():
        assert abs(r.k - r.t) < 0.1 * r.t


# --- chat ---------------------------------------------------------------------------------


def test_chat_round_trip(spark):
    odd = ["<|im_end|>\n<|im_start|>assistant<|im_sep|>x", "\\", "a\\<|b", "<", "|im_end|>", "", "é\n\n", "\\<\\|", "<|im_next|>"]
    rows = [(1, i, ["user", "assistant", "assistant"][i % 3], t) for i, t in enumerate(odd)]
    rows += [(2, None, "user", None), (2, 0, "rôle\n<|im_sep|>", "t"), (None, 1, None, "x"), (3, 1, "user", "same"), (3, 1, "user", "same")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("segments", F.lit(1))
    out = chat.format_conversations(df).select("conv_id", chat.formatted(F.col("segments")).alias("f"), chat.loss_text(F.col("segments")).alias("l"))
    assert all(r.a == r.l for r in out.select("l", chat.read_loss(chat.read_turns(F.col("f"))).alias("a")).collect())
    got = {r.conv_id: (r.t, r.l, r.f) for r in out.select("*", chat.read_turns(F.col("f")).alias("t")).collect()}
    assert [tuple(t) for t in got[1][0]] == [(r[2], r[3]) for r in rows[:9]]
    assert got[1][1] == "".join(r[3] for r in rows[:9] if r[2] == "assistant")
    assert got[1][2].count("<|im_start|>") == 6  # adjacent turns of one role share a message
    assert [tuple(t) for t in got[2][0]] == [("user", ""), ("rôle\n<|im_sep|>", "t")]
    assert [tuple(t) for t in got[None][0]] == [("", "x")]
    assert [tuple(t) for t in got[3][0]] == [("user", "same")] * 2
    turns = F.from_json(F.lit('[{"role":"a","text":"1"},{"role":"a","text":"2"},{"role":"b","text":"3"},{"role":"a","text":"4"}]'), "array<struct<role:string,text:string>>")
    merged = spark.range(1).select(chat.messages(turns).alias("m")).first().m
    assert [(m.role, m.texts) for m in merged] == [("a", ["1", "2"]), ("b", ["3"]), ("a", ["4"])]


def test_long_conversations(spark):
    rows = [(1, i, "user" if i % 5 else "assistant", f"turn {i} <|im_end|>") for i in range(3000)] + [(2, 0, "assistant", "<|\\" * 200_000), (2, 1, "assistant", "é" * 300_000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r.conv_id: r for r in chat.op3(df).collect()}
    for c in (1, 2):
        own = [r for r in rows if r[0] == c]
        assert got[c].n_turns == len(own) and got[c].loss_chars == sum(len(r[3]) for r in own if r[2] == "assistant")
        assert got[c].turns_sha256 == hashlib.sha256("".join(f"{r[2]}\n{r[3]}\n" for r in own).encode()).hexdigest()


# --- token files --------------------------------------------------------------------------


def plain_ids(text):
    """Ids of the tokenizers library itself, by a tokenizer of its own."""
    from tokenizers import Tokenizer

    if not _plain:
        _plain.append(Tokenizer.from_file(tokens.default_tokenizer()))
    return _plain[0].encode(text, add_special_tokens=False).ids


_plain = []


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 1 << 20), max_size=700))
def test_elias_fano(values):
    values.sort()
    s = eliasfano.Sequence(eliasfano.encode(np.array(values, np.uint64)))
    assert s.select(0, len(values)).tolist() == values and [s[i] for i in range(len(values))] == values
    for a in range(0, len(values), 97):
        assert s.select(a, min(a + 300, len(values))).tolist() == values[a:a + 300]


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("abst'é 1\n\t!.,€漢𝔘 　\x85\x1c\r<|>")) | st.characters(codec="utf-8"), max_size=60))
def test_pieces_give_the_ids_of_the_text(text):
    e = tokens.encoder(tokens.default_tokenizer())
    assert np.frombuffer(e.texts([text], 2)[0], e.dtype).tolist() == plain_ids(text) + [2]


def test_pieces_give_the_ids_of_every_document(spark):
    e = tokens.Encoder(tokens.default_tokenizer())
    texts = [r.text or "" for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").collect()]
    for t, ids in zip(texts, e.texts(texts, 2)):
        assert np.frombuffer(ids, e.dtype).tolist() == plain_ids(t) + [2]


def test_literal_special_tokens_as_the_plain_library_has_them():
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(tokens.default_tokenizer())
    texts = ["a<|endoftext|>b", "<|endoftext|>", "x <|endoftext|> <|endoftext|>y\n", "a <|endoftext b|>", "no literal here, twice"]
    got = tokens.Encoder(tokens.default_tokenizer()).texts(texts, 2)
    assert [np.frombuffer(b, "<u2")[:-1].tolist() for b in got] == [plain.encode(t, add_special_tokens=False).ids for t in texts]


def test_token_files(spark):
    rng = random.Random(1)
    rows = [(i * 7 % 101, sentence(rng, rng.randrange(0, 40))) for i in range(60)] + [(500, None), (None, "no id"), (600, "long " * 60_000), (7, "<|endoftext|>"), (601, "twice"), (601, "twice")]
    df = make(spark, rows)
    seg = tokens.write_tokens(df, tokens.default_tokenizer())
    got = [tuple(r) for r in tokens.read_tokens(seg).orderBy("start").collect()]
    at, want = 0, []
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = plain_ids(t or "") + [2]
        want.append((i, at, len(ids), zlib.crc32(np.array(ids, "<u4"))))
        at += len(ids)
    assert got == want
    first = seg.orderBy("part", "seg").first()
    assert tokens.Segment(bytes(first.payload)).document(0).tolist() == plain_ids("no id") + [2]


# --- repeated strings ---------------------------------------------------------------------


def brute_repeats(rows, n=suffixdedup.LENGTH):
    seen, out = set(), []
    for key, t in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for p in range(len(b) - n + 1):
            if b[p:p + n] in seen:
                gone[p:p + n] = b"\1" * n
            else:
                seen.add(b[p:p + n])
        kept = bytes(x for x, f in zip(b, gone) if not f)
        out.append((key, len(b), sum(gone), len([x for x in bytes(gone).split(b"\0") if x]), hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("slice_bytes, shard_bytes", [(512 << 10, 512 << 10), (3000, 900)])
def test_repeats_match_brute_force(spark, monkeypatch, slice_bytes, shard_bytes):
    monkeypatch.setattr(suffixdedup, "SLICE_BYTES", slice_bytes)
    monkeypatch.setattr(suffixdedup, "SHARD_BYTES", shard_bytes)
    rng = random.Random(3)
    passage, line = sentence(rng, 40), sentence(rng, 14)
    rows = []
    for i in range(80):
        t = sentence(rng, rng.randrange(0, 60))
        if i % 3 == 0:
            t += " " + passage[rng.randrange(30):] + sentence(rng, 8)
        if i % 4 == 0:
            t = line + "\n" + t + "\n" + line
        rows.append((i, t))
    rows += [(80, rows[0][1]), (81, None), (82, ""), (83, "ab" * 300), (84, "z" * 99), (85, "z" * 400), (86, "é" * 120), (87, "x" * 100), (88, "x" * 100), (89, "ab" * 300)]
    rng.shuffle(rows)
    got = sorted(tuple(r) for r in suffixdedup.op5(make(spark, rows)).collect())
    assert got == brute_repeats(sorted(rows))


def test_repeats_with_ids_that_repeat(spark):
    t = "q" * 30 + sentence(random.Random(8), 30)
    got = sorted((r.doc_id is None, r.n_removed) for r in suffixdedup.op5(make(spark, [(1, t), (1, t), (None, t), (2, None)])).collect())
    assert got == [(False, 0), (False, len(t)), (False, len(t)), (True, 0)]


def test_one_anchor_with_many_surroundings_goes_to_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(suffixdedup, "SHARD_BYTES", 2000)
    rng = random.Random(5)
    letters = lambda n: bytes(rng.choice(b"abcdefgh") for _ in range(n))
    anchor, sides = letters(32), [(letters(68), letters(68)) for _ in range(60)]
    # each text stands alone, shares one side with others, or comes again as a whole
    rows = [(i, a + anchor + b) for i, (a, b) in enumerate(sides)]
    rows += [(60 + i, sides[rng.randrange(60)][0] + anchor + sides[rng.randrange(60)][1]) for i in range(100)]
    rows += [(160 + i, rows[rng.randrange(160)][1]) for i in range(40)]
    stretches = spark.createDataFrame([(7, no, 0, 69, bytearray(t)) for no, t in rows], "hash long, no long, first long, n int, text binary")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        tasks = suffixdedup._dealt(stretches).groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(tasks) > 1 and max(r["count"] for r in tasks) < 120
    seen, wanted = set(), set()
    for no, t in rows:
        for p in range(69):
            if t[p:p + 100] in seen:
                wanted |= {(no, x) for x in range(p, p + 100)}
            seen.add(t[p:p + 100])
    assert {(r.no, x) for r in suffixdedup._marks(stretches).collect() for x in range(r.begin, r.end)} == wanted


def test_bytes_decide_where_hashes_agree(monkeypatch):
    monkeypatch.setattr(suffixdedup, "mix64", lambda x: x * np.uint64(0))
    texts = [b"a" * 100, b"b" * 100, b"b" * 100, b"c" * 120, b"a" * 99 + b"b", b"a" * 99 + b"b"]
    sizes = np.array([len(t) for t in texts])
    data = np.frombuffer(b"".join(texts), np.uint8)
    again = suffixdedup._equal_before(np.zeros(6, np.uint64), data, np.cumsum(sizes) - sizes, sizes)
    assert again.tolist() == [False, False, True, False, False, True]


def test_windows_of_many_shards_merge(spark, monkeypatch):
    monkeypatch.setattr(suffixdedup, "SHARD_BYTES", 1500)
    rng = random.Random(2)
    pool = [bytes(rng.choice(b"\0ab") for _ in range(98)) + end for end in (b"\0\0", b"\0a", b"a\0") for _ in range(25)]
    rows = [(no, begin, begin + 100, bytearray(rng.choice(pool))) for no in range(40) for begin in range(8)]
    rng.shuffle(rows)
    first = {}
    for no, begin, _, w in sorted(rows):
        first.setdefault(bytes(w), (no, begin))
    want = sorted(r[:3] for r in rows if first[bytes(r[3])] != r[:2])
    got = suffixdedup._merged(spark.createDataFrame(rows, "no long, begin long, end long, window binary"))
    assert sorted(map(tuple, got.collect())) == want


@settings(max_examples=30, deadline=None)
@given(st.integers(0, 10_000), st.integers(1, 3))
def test_suffix_order(seed, letters):
    rng = np.random.default_rng(seed)
    sizes = rng.integers(100, 220, 6)
    data = rng.integers(97, 97 + letters, sizes.sum()).astype(np.uint8)
    begins = np.concatenate(([0], np.cumsum(sizes)[:-1]))
    order, _ = suffixdedup.suffix_array(data, begins, sizes)
    windows = [(bytes(data[p:p + 100]), p) for b, s in zip(begins, sizes) for p in range(b, b + s - 99)]
    windows.sort()
    assert [p for _, p in windows] == order.tolist()
    same = [False] + [a[0] == b[0] for a, b in zip(windows, windows[1:])]
    assert suffixdedup.common_prefix(data, order).tolist() == same


# --- embeddings ---------------------------------------------------------------------------


def brute_links(rows, least=0.98):
    good = [(i, l, np.array(e, float)) for i, l, e in rows if l is not None and e and all(x is not None and np.isfinite(x) for x in e) and any(e)]
    near = collections.defaultdict(set)
    for a in range(len(good)):
        for b in range(a + 1, len(good)):
            (i, l, x), (j, k, y) = good[a], good[b]
            if l == k and len(x) == len(y) and x @ y >= least * np.sqrt(x @ x) * np.sqrt(y @ y):
                near[i].add(j)
                near[j].add(i)
    out = {}
    for i, _, _ in rows:
        seen, todo = {i}, [i]
        while todo:
            todo += [j for j in near[todo.pop()] if j not in seen and not seen.add(j)]
        out[i] = (len(near[i]), min(seen))
    return out


def test_range_join_matches_brute_force(spark, monkeypatch):
    monkeypatch.setattr(metricjoin, "CELL_ROWS", 20)
    monkeypatch.setattr(metricjoin, "BLOCK", 16)
    rng = np.random.default_rng(4)
    rows, i = [], 0
    for label in (1, 2, 3):
        for _ in range(8):
            centre = rng.normal(size=12)
            for _ in range(rng.integers(1, 14)):
                rows.append((i, label, (centre + rng.normal(size=12) * 0.14).astype(np.float32).tolist()))
                i += 1
    for _ in range(30):
        rows.append((i, 1, rows[0][2]))
        i += 1
    rows += [(i, None, rows[0][2]), (i + 1, 1, None), (i + 2, 1, [0.0] * 12), (i + 3, 1, [float("nan")] * 12), (i + 4, 1, []), (i + 5, 1, [1.0, None]), (i + 6, 2, [2.0 * x for x in rows[-1][2]]), (i + 7, 1, [1.0, 2.0])]
    df = spark.createDataFrame([(a, b, c, "x") for a, b, c in rows], "vec_id long, label int, embedding array<float>, cell string")
    got = {r.vec_id: (r.n_links, r.component_id) for r in metricjoin.op6(df).collect()}
    want = brute_links([(a, b, None if c is None else [None if x is None else float(np.float32(x)) for x in c]) for a, b, c in rows])
    assert got == want and sum(n for n, _ in want.values()) > 1000


def test_vectors_of_any_magnitude(spark):
    rows = [(1, [1e-200, 0.0]), (2, [0.0, 1e-200]), (3, [1e-200, 1e-200]), (4, [5e199, 5e199]), (5, [1e308, 0.0]), (6, [5e-324, 0.0]), (7, [3.0, 0.0])]
    df = spark.createDataFrame([(i, "x", e) for i, e in rows], "vec_id long, label string, embedding array<double>")
    got = {r.vec_id: (r.n_links, r.component_id) for r in metricjoin.op6(df).collect()}
    assert got == {1: (3, 1), 5: (3, 1), 6: (3, 1), 7: (3, 1), 2: (0, 2), 3: (1, 3), 4: (1, 3)}


def test_many_small_labels_need_no_pivots(spark):
    rows = [(i, f"l{i // 3}", [1.0, i % 3 * 0.01]) for i in range(300)]
    df = spark.createDataFrame(rows, "vec_id long, label string, embedding array<double>")
    classes = df.selectExpr("vec_id AS cid", "label", "embedding")
    assert not metricjoin._pivots(classes).groups
    assert {(r.n_links, r.component_id) for r in metricjoin.op6(df).collect()} == {(2, i) for i in range(0, 300, 3)}


# --- pages --------------------------------------------------------------------------------


def test_pages_of_the_tables(spark, sf):
    def main_text(h):
        a = h[h.index("<article>") + 9:]
        a = a[:a.index("</article>")]
        import html

        parts = [" ".join(html.unescape(re.sub(r"<[^>]*>", " ", b)).split()) for b in re.split(r"</?(?:p|h1)>", a)]
        return "\n".join(p for p in parts if p)

    pages = spark.read.parquet(f"{sf}/pages.parquet")
    want = {r.page_id: main_text(r.html) for r in pages.collect()}
    got = {r.page_id: r.text for r in pagetext.op7(pages).collect()}
    assert got == want


def test_model_on_pages_held_out():
    model = htmlmodel.trained()
    right = total = 0
    made = [htmlmodel.labelled_page(s) for s in range(5000, 5150)]
    for p, (tree, y) in zip(model.content([t for t, _ in made]), made):
        has_text = np.array(tree.own) > 0
        right += int((((p >= 0.5) == y) & has_text).sum())
        total += int(has_text.sum())
    assert right / total > 0.97


def test_page_parts(spark):
    page = """<html><body><div id=cookie-notice>We use cookies.</div><nav><a href=/>Home</a></nav><article><h1>Big &amp; small</h1>
    <p>First <b>bold</b>   words &lt;x&gt; &eacute;.<p>Second one &amp goes on<br>here for a while.</p><script>var a = "<p>no</p>";</script></article>
    <section class="comments"><p>A reader wrote a comment of some length here.</p></section><form><label>Mail</label><button>Go</button></form><footer>&copy; all</footer></body></html>"""
    rows = [(1, page), (2, None), (3, ""), (4, "only &lt;text&gt;\n here"), (5, "<<>><p"), (6, "<p>" + "word " * 100_000 + "</p>")]
    df = spark.createDataFrame(rows, "page_id long, html string").withColumn("text", F.lit(3))
    got = {r.page_id: (r.text, r.n_chars) for r in pagetext.extract_text(df).collect()}
    assert got[1][0] == "Big & small\nFirst bold words <x> é.\nSecond one & goes on here for a while."
    assert got[2] == got[3] == ("", 0)
    assert got[4][0] == "only <text> here" and got[6][1] == 499_999
    assert len(got) == 6


def test_markup_that_training_pages_lack(spark):
    t = "The council met on Tuesday to talk about the new bridge over the river, which has been closed since spring."
    pages = [
        (f"<div>{t}</div><div>{t} {t}</div>", f"{t}\n{t} {t}"),
        (f"<table><tr><td><a href=1>Home</a> <a href=2>News</a></td></tr><tr><td><font size=4>Bridge</font><br>{t} {t}</td></tr><tr><td><a href=4>Imprint</a></td></tr></table>", f"Bridge {t} {t}"),
        (f"<div role=banner>City paper</div><div role=navigation><a href=1>Home</a></div><div role=main><h1>Bridge</h1><p>{t}</p></div><div role=contentinfo>All rights reserved</div>", f"Bridge\n{t}"),
        (f"<div class=css-1x9><a href=1>Home</a><a href=2>News</a></div><div class=css-88a><div class=css-p1><p>{t}<p>{t}</div></div><div class=css-00f><a href=4>Imprint</a></div>", f"{t}\n{t}"),
        (f"<main><header><h1>Bridge</h1></header><section><p>{t}</p><figure><img src=x><figcaption>The bridge</figcaption></figure><p>{t}</p></section><aside class=related><a href=1>More</a></aside></main>", f"Bridge\n{t}\nThe bridge\n{t}"),
        (f"<article><p>Let <math><mi>x</mi></math> be <svg><title>no</title><text>drawn</text></svg> in <object>words</object>. {t}</p><noscript>{t}</noscript></article>", f"Let x be drawn in words. {t}\n{t}"),
        (f"<article><p title='it\"s > that'>{t}</p><p>{t}<a href=\"open>", f"{t}\n{t}"),
    ]
    df = spark.createDataFrame([(i, h) for i, (h, _) in enumerate(pages)], "page_id long, html string")
    got = {r.page_id: r.text for r in pagetext.extract_text(df).collect()}
    assert got == {i: want for i, (_, want) in enumerate(pages)}


@pytest.mark.parametrize("part", ['<a "', "<a '\"", "<div>", "<blockquote>", "<li><div>", "<title>", "<!-- x", "<![CDATA[", "</x ", '<a b="', "</p>", "<", "<p><table>"])
def test_bad_markup_takes_linear_time(part):
    began = time.perf_counter()
    htmltree.parse(part * 20_000)
    htmltree.parse(part * 20_000 + ">")
    assert time.perf_counter() - began < 5


def test_messages_give_exact_marginals():
    trees = [htmltree.parse("<div><p>a</p><p>b</p></div><nav><ul><li>c</li></ul></nav>")]
    forest = htmlmodel.Forest(trees)
    rng = np.random.default_rng(0)
    n = len(forest.parent)
    unary, edge = rng.normal(size=(n, 2)), rng.normal(size=(2, 2))
    got, _ = htmlmodel.sum_product(forest, unary, edge)
    want = np.zeros((n, 2))
    for k in range(1 << n):
        y = [k >> i & 1 for i in range(n)]
        w = np.exp(sum(unary[i, y[i]] for i in range(n)) + sum(edge[y[p], y[i]] for i, p in enumerate(forest.parent) if p >= 0))
        for i in range(n):
            want[i, y[i]] += w
    assert np.allclose(got, want / want.sum(axis=1, keepdims=True))


# --- near-duplicates ----------------------------------------------------------------------


def brute_groups(rows, percent=75):
    def shingles(t):
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())

    sets = [(i, shingles(t)) for i, t in rows]
    root = {i: i for i, _ in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(sets)):
        for b in range(a + 1, len(sets)):
            (i, x), (j, y) = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                p, q = find(i), find(j)
                root[max(p, q)] = min(p, q)
    return {i: (len(s), find(i)) for i, s in sets}


@pytest.mark.parametrize("small", [24, 0])
def test_near_duplicates_match_brute_force(spark, monkeypatch, small):
    monkeypatch.setattr(neardup, "SMALL", small)
    monkeypatch.setattr(neardup, "BLOCK", 8)
    rng = random.Random(6)
    rows, i = [], 0
    for _ in range(6):
        base = sentence(rng, 80).split()
        for _ in range(20):
            w = list(base)
            for _ in range(rng.randrange(0, 5)):
                w[rng.randrange(len(w))] = f"new{rng.randrange(9)}"
            rows.append((i, " ".join(w)))
            i += 1
    rows += [(i, None), (i + 1, ""), (i + 2, "One two"), (i + 3, "one TWO"), (i + 4, "two one"), (i + 5, rows[3][1].upper()), (i + 6, " \t\n"), (i + 7, "long " * 40_000)]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in neardup.op8(make(spark, rows)).collect()}
    want = brute_groups(rows)
    assert {k: v for k, v in got.items()} == want
    assert 6 < len({c for _, c in want.values()}) < len(rows)


def test_near_duplicates_without_ids(spark):
    t = sentence(random.Random(2), 30)
    df = make(spark, [(5, t), (5, t), (None, t), (9, t)])
    got = sorted((r.doc_id or -1, r.component_id, r.kept) for r in neardup.op8(df).collect())
    assert got == [(-1, None, True), (5, 5, True), (5, 5, True), (9, 5, False)]
    out = neardup.drop_duplicates(df)
    assert out.columns == df.columns and out.count() == 3


def test_texts_under_one_id_hang_together(spark):
    a, b, c = (sentence(random.Random(k), 30) for k in (2, 3, 4))
    df = make(spark, [(3, a), (5, a), (4, b), (5, b), (9, c), (8, c), (9, b)])
    assert {(r.doc_id, r.component_id) for r in neardup.op8(df).collect()} == {(i, 3) for i in (3, 4, 5, 8, 9)}


def test_recall_just_above_the_threshold(spark):
    # pairs of similarity 0.75 to 0.8, each of words of its own, so that nothing else links them
    rows = []
    for k in range(600):
        n = 40 + k % 60
        own = [f"p{k}w{i}" for i in range(n + 4)]
        gone = int((0.80 - 0.05 * (k % 11) / 10) * 2 * n / (1.80 - 0.05 * (k % 11) / 10))
        rows += [(2 * k, " ".join(own)), (2 * k + 1, " ".join(own[:gone + 4] + [f"q{k}w{i}" for i in range(n - gone)]))]
    sets = [{tuple(w[i:i + 5]) for i in range(len(w) - 4)} for w in (t.split() for _, t in rows)]
    alike = [k for k in range(600) if 0.75 <= len(sets[2 * k] & sets[2 * k + 1]) / len(sets[2 * k] | sets[2 * k + 1]) <= 0.8]
    got = {r.doc_id: r.component_id for r in neardup.op8(make(spark, rows)).collect()}
    assert len(alike) > 400
    assert sum(got[2 * k + 1] == 2 * k for k in alike) / len(alike) >= 0.99
    assert all(got[2 * k + 1] == 2 * k + 1 for k in set(range(600)) - set(alike) if len(sets[2 * k] & sets[2 * k + 1]) / len(sets[2 * k] | sets[2 * k + 1]) < 0.75)


def test_filings_meet_within_reach():
    rng = np.random.default_rng(9)
    a = rng.integers(0, 1 << 16, (200, neardup.K)).astype(np.uint16)
    b = a.copy()
    for row in b:
        at = rng.choice(neardup.K, neardup.REACH, replace=False)
        row[at] ^= rng.integers(1, 1 << 16, neardup.REACH).astype(np.uint16)
    assert ((neardup.filings(a) == neardup.filings(b)).any(axis=1)).all()


def test_parity_bounds_the_difference():
    rng = np.random.default_rng(3)
    for n, k in ((50, 10), (400, 100), (3000, 2)):
        x, y = (np.unique(rng.integers(0, 1 << 63, n, np.uint64)) for _ in range(2))
        y[:len(y) - k] = x[:len(y) - k]
        y = np.unique(y)
        p = neardup.parities(np.concatenate([x, y]), np.array([0, len(x), len(x) + len(y)]))
        a, b = (np.frombuffer(v.as_buffer(), np.uint8) for v in p)
        assert neardup.differing(a, b) <= len(np.setxor1d(x, y))


def test_components(spark):
    rng = random.Random(4)
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 60)] + [(7, 7), (None, 3), (200, 201), (201, 150)]
    rng.shuffle(edges)
    got = dict((r.id, r.component) for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect())
    want = {i: 0 for i in range(41)} | {i: 100 for i in range(100, 160)} | {150: 100, 200: 100, 201: 100}
    assert got == want


def test_components_extend(spark):
    labels = components.components(spark.createDataFrame([(1, 2), (5, 6)], "a long, b long"))
    more = components.extend(labels, spark.createDataFrame([(6, 2), (8, 9)], "a long, b long"))
    assert {r.id: r.component for r in more.collect()} == {1: 1, 2: 1, 5: 1, 6: 1, 8: 8, 9: 8}


# --- decontamination ----------------------------------------------------------------------


def brute_hits(docs, tests, n=13):
    def split(t):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))

    windows = collections.defaultdict(set)
    for item, t in tests:
        w = split(t)
        if w and item is not None:
            for i in range(max(1, len(w) - n + 1)):
                windows[tuple(w[i:i + n])].add(item)
    out = []
    for key, t in docs:
        w, hit, items = split(t), set(), set()
        for size in {len(x) for x in windows}:
            for i in range(len(w) - size + 1):
                found = windows.get(tuple(w[i:i + size]))
                if found:
                    hit |= set(range(i, i + size))
                    items |= found
        names = ",".join(sorted(map(str, items)))
        out.append((key, len(w), len(hit), len(items), hashlib.sha256(names.encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w)))
    return out


@pytest.mark.parametrize("block, whole, vocabulary", [(150_000, True, 0), (150_000, False, 2_000_000), (40, False, 10)])
def test_decontamination_matches_brute_force(spark, monkeypatch, block, whole, vocabulary):
    monkeypatch.setattr(decontaminate, "BLOCK_WINDOWS", block)
    monkeypatch.setattr(decontaminate, "VOCABULARY_ROWS", vocabulary)
    monkeypatch.setattr(decontaminate.decontaminate, "__defaults__", (13, whole))
    rng = random.Random(11)
    tests = [(i, sentence(rng, rng.choice([3, 12, 13, 14, 40]))) for i in range(12)] + [(12, None), (13, "..."), (None, "no id here"), (14, "a a a a a a a a a a a a a a"), (3, "other text of item three"), (15, "other text of item three")]
    docs = []
    for i in range(50):
        t = sentence(rng, rng.randrange(0, 60))
        if i % 2:
            t += " !! " + rng.choice(tests)[1].__str__().upper().replace(" ", " - ") + " " + sentence(rng, 5)
        docs.append((i, t))
    docs += [(50, None), (51, ""), (52, "a " * 40), (53, tests[0][1]), (53, tests[0][1]), (None, tests[1][1]), (54, "long9 " * 50_000 + tests[4][1])]
    bench = spark.createDataFrame([(i, t, 1) for i, t in tests], "item_id long, text string, terms int")
    key = lambda r: (r[0] is None, r[0] or 0, r[1:])
    got = sorted((tuple(r) for r in decontaminate.op9(make(spark, docs), bench).collect()), key=key)
    assert got == sorted(brute_hits(docs, tests), key=key)
    kept = decontaminate.drop_contaminated(make(spark, docs), bench)
    assert kept.count() == sum(not r[5] for r in brute_hits(docs, tests))


def test_proximity_matches_brute_force(spark):
    rng = random.Random(21)
    pool = [f"w{i}" for i in range(40)]
    text = lambda n: " ".join(rng.choice(pool) for _ in range(n))
    docs = [(i, text(rng.randrange(0, 120))) for i in range(60)] + [(60, None), (61, ""), (None, text(80)), (62, "red x x fox jumps"), (63, "fox " + "y " * 30 + "red jumps"), (63, "jumps fox red"), (64, "red fox"), (65, "jumps")]
    tests = [(i, text(n)) for i, n in enumerate((1, 2, 3, 4, 15))] + [(9, "red fox jumps"), (10, None), (11, "!"), (None, "red")]
    count = collections.Counter(w for _, t in docs for w in (t or "").split())
    want = set()
    for item, t in tests:
        words = [w for w in (t or "").split() if w != "!"]
        for i in range(max(1, len(words) - 12) if words and item is not None else 0):
            win = words[i:i + 13]
            rare = min(range(len(win)), key=lambda k: (count[win[k]], k))
            for key, d in docs:
                own = (d or "").split()
                for p, w in enumerate(own):
                    if w == win[rare] and set(win) <= set(own[max(0, p - 5):p + 6]):
                        want.add((key, item, p))
    bench = spark.createDataFrame(tests, "item_id long, text string")
    for whole in (True, False):
        got = decontaminate.proximity_matches(make(spark, docs), bench, 5, whole=whole)
        assert set(map(tuple, got.collect())) == want and got.count() == len(want)
    assert {(62, 9, 0), (63, 9, 1)} & want and not any(k in (64, 65) and i == 9 for k, i, _ in want)


# --- language -----------------------------------------------------------------------------


def test_languages_held_out(spark):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    got = langid.op10(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").toPandas()
    assert len(got) > 200 and (got.lang_pred == got.lang).mean() > 0.98
    assert got.score.between(0, 1).all()


def test_predictions_match_plain_sets(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    train = docs.where(~langid.held_out(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").isNotNull())

    def grams(text):
        # what a text of letters and bytes beyond ASCII holds of four bytes without two blanks in a row
        b = bytes(x if x >= 128 or 97 <= x <= 122 else 32 for x in f" {text.lower()} ".encode())
        return [g for g in (b[i:i + 4] for i in range(len(b) - 3)) if b"  " not in g]

    counts, sizes = collections.defaultdict(collections.Counter), collections.Counter()
    for r in train.select("text", "lang").collect():
        sizes[r.lang] += 1
        counts[r.lang].update(grams(r.text))
    mass = {x: sum(c.values()) for x, c in counts.items()}
    top = collections.Counter()
    for x, c in counts.items():
        for g, n in c.items():
            top[g] = max(top[g], n / mass[x])
    sets = {x: {g for g, n in c.items() if n >= langid.LEAST_COUNT and n / mass[x] >= langid.SHARE * top[g]} for x, c in counts.items()}
    got = {r.doc_id: r for r in langid.op10(docs).collect()}
    same = clear = 0
    for r in docs.collect():
        if r.text is None or not any(c.isalpha() for c in r.text):
            assert (got[r.doc_id].lang_pred, got[r.doc_id].score) == ("und", 0.0)
            continue
        found = {x: sum(g in s for g in grams(r.text)) for x, s in sets.items()}
        # the sets themselves: no language comes near the first but by as many n-grams as the filters may be wrong in
        first, second = sorted(found.values())[:-3:-1]
        if first - second > 1 + 0.01 * len(r.text):
            clear += 1
            same += got[r.doc_id].lang_pred == max(found, key=found.get)
    assert clear > 0.9 * len(got) and same == clear


def test_ties_fall_to_the_commonest_language(spark):
    rows = [(i, "alpha beta gamma", x) for i, x in enumerate(["b", "b", "c", "c", "c", "a", "a"] * 9)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").selectExpr("*", "1 AS _lang", "2 AS row", "3 AS letter")
    model = langid.train(df)
    asked = spark.createDataFrame([(1, "alpha beta gamma"), (2, "zzzz qqqq xxxx")], "doc_id long, text string")
    assert [r.lang_pred for r in langid.identify(asked, model).collect()] == ["c", "c"]
    out = langid.identify(df, model)
    assert out.columns == [*df.columns, "lang_pred", "lang_score"] and out.first()["_lang"] == 1


def test_more_languages_than_a_word_and_rare_ones(spark):
    rng = random.Random(4)
    words = [["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(6)) for _ in range(30)] for _ in range(80)]
    text = lambda i: " ".join(rng.choice(words[i]) for _ in range(40))
    # the last language is rare: a uniform sample of 200 rows of 4,000 would take about one of its rows
    rows = [(k, text(i), f"l{i:02}") for k, i in enumerate([0] * 3000 + [i for i in range(80) for _ in range(12)] + [79] * 10)]
    model = langid.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"), sample_rows=200)
    asked = spark.createDataFrame([(i, text(i)) for i in range(80)], "doc_id long, text string")
    assert {r.doc_id: r.lang_pred for r in langid.identify(asked, model).collect()} == {i: f"l{i:02}" for i in range(80)}


def test_language_edges(spark):
    rows = [(1, "the house and the bird", "en"), (2, "das haus und der vogel", "de"), (3, None, "de"), (4, "1234 !!", None), (5, "", "en"), (6, "漢字", None), (7, "the " * 60_000, None), (8, "THE HOUSE AND THE BIRD", None)]
    df = spark.createDataFrame([(i + 100 * k, t, l) for k in range(4) for i, t, l in rows], "doc_id long, text string, lang string").withColumn("lang_score", F.lit("x"))
    model = langid.train(df)
    got = {r.doc_id: (r.lang_pred, r.lang_score) for r in langid.identify(df, model).collect()}
    assert got[1][0] == "en" and got[2][0] == "de" and got[7][0] == "en" and got[8][0] == "en"
    assert got[3] == got[4] == got[5] == ("und", 0.0)
    assert got[6][0] in ("en", "de")
    none = langid.identify(df, langid.train(df.where("lang = 'xx'")))
    assert {r.lang_pred for r in none.collect()} == {"und"}
    kept = langid.with_language(df, model)
    assert kept.columns == df.columns and kept.count() == 5 * 4


# --- byte scans ---------------------------------------------------------------------------


def test_slices_cover_every_row():
    import pyarrow as pa

    col = pa.array(["ab", None, "", "é" * 50, "x"] * 20)[3:]
    seen = []
    for a, b, data, offsets in bytescan.slices(col, 64):
        seen += [bytes(data[offsets[i]:offsets[i + 1]]).decode() for i in range(b - a)]
    assert seen == [x or "" for x in col.to_pylist()]


# --- pipeline -----------------------------------------------------------------------------


def test_pipeline_matches_brute_force(spark, sf):
    import corpus_pipeline

    docs = spark.read.parquet(f"{sf}/documents.parquet").toPandas()
    bench = spark.read.parquet(f"{sf}/benchmark.parquet").toPandas()
    docs = docs[docs.text.map(lambda t: bool(t) and any(c.isalpha() for c in t))]
    groups = brute_groups(list(zip(docs.doc_id, docs.text)))
    docs = docs[[groups[i][1] == i for i in docs.doc_id]]
    bad = {r[0] for r in brute_hits(list(zip(docs.doc_id, docs.text)), list(zip(bench.item_id, bench.text))) if r[5]}
    docs = docs[~docs.doc_id.isin(bad)]
    mixed = mixing.mix(spark.createDataFrame(docs[["doc_id", "text", "source"]])).toPandas()
    at, want = 0, []
    for r in mixed.sort_values("doc_id").itertuples():
        ids = plain_ids(r.text) + [2]
        for _ in range(r.mix_copies):
            want.append((r.doc_id, at, len(ids), zlib.crc32(np.array(ids, "<u4"))))
            at += len(ids)
    got = [tuple(r) for r in corpus_pipeline.run(spark, sf).orderBy("start").collect()]
    assert got == want and bad


def test_stages_keep_columns(spark, sf):
    import corpus_pipeline

    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, sf).columns == docs.columns


ODD = [(1, "one two three four five six", "en", "s"), (1, "one two three four five six", "en", "s"), (2, None, None, None), (3, "", "en", "s"), (None, "drei vier fünf sechs sieben acht", "de", None), (4, "1 2 3", "de", "t"), (5, "long words " * 30_000, None, "t"), (6, "ONE two three four five six", "en", "u"), (7, "漢字", None, "s")]


def test_pipeline_on_odd_and_empty_tables(spark, tmp_path):
    import corpus_pipeline

    full = [(i, t, l, s, len(t or ""), {"k": 1}) for i, t, l, s in ODD]
    docs = spark.createDataFrame(full, DOCS + ", `row` map<string,int>")
    bench = spark.createDataFrame([(1, "no such text"), (None, None)], "item_id long, text string")
    for name, d, b in (("odd", docs, bench), ("no_docs", docs.limit(0), bench), ("no_tests", docs, bench.limit(0)), ("none", docs.limit(0), bench.limit(0))):
        d.write.parquet(f"{tmp_path}/{name}/documents.parquet")
        b.write.parquet(f"{tmp_path}/{name}/benchmark.parquet")
        got = corpus_pipeline.run(spark, f"{tmp_path}/{name}").orderBy("start").collect()
        if "no_docs" in name or name == "none":
            assert not got
            continue
        # a null, an empty, a wordless text and the copies go; ids follow each other without a gap
        assert len(corpus_pipeline.STAGES[1][1](spark, d, f"{tmp_path}/{name}").where("doc_id = 1").collect()) == 1
        assert {r.doc_id for r in got} <= {None, 1, 5, 7} and len({r.doc_id for r in got}) > 1
        assert [r.start for r in got] == np.cumsum([0] + [r.n_tokens for r in got])[:-1].tolist()


def test_one_of_repeated_rows_is_left(spark):
    text, near = "a b c d e f g h i j k l m n o p q r s t u v w x y z", "a b c d e f g h i j k l m n o p q r s t u v w x y zz"
    other = "quite another text of some words that is like nothing else in this table at all"
    rows = [(1, other), (1, other), (None, "drei vier fünf sechs sieben"), (None, "drei vier fünf sechs sieben"), (None, None), (None, None), (2, ""), (2, ""), (3, "")]
    rows += [(9, text), (5, near), (None, text), (4, "one doc_id but two texts, this"), (4, "and here the other one, which is not alike")]
    got = neardup.drop_duplicates(make(spark, rows).repartition(3))
    assert got.columns == make(spark, rows).columns
    want = {(1, other): 1, (None, "drei vier fünf sechs sieben"): 1, (None, None): 1, (2, ""): 1, (3, ""): 1, (5, near): 1, rows[-2]: 1, rows[-1]: 1}
    assert collections.Counter((r.doc_id, r.text) for r in got.collect()) == want


def test_chain_through_a_vector_without_id(spark):
    """1 and 2 link with a vector without vec_id only; two of those without ids link with each other."""
    at = lambda a: [float(np.cos(a)), float(np.sin(a))]
    rows = [(1, "a", at(0.0)), (None, "a", at(0.15)), (2, "a", at(0.3)), (None, "a", at(2.0)), (None, "a", at(2.1)), (7, "a", at(4.0))]
    df = spark.createDataFrame(rows, "vec_id long, label string, embedding array<double>")
    got = sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in metricjoin.op6(df).collect()), key=str)
    assert got == sorted([(1, 1, 1, True), (None, 2, None, True), (2, 1, 1, False), (None, 1, None, True), (None, 1, None, True), (7, 0, 7, True)], key=str)


def test_pivots_spare_pairs_on_the_tables(spark, monkeypatch):
    """At the driver's size every label has pivots, and fewer pairs are compared than a label has."""
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").select("vec_id", "label", "embedding")
    tables = {}
    plain = metricjoin.cut
    monkeypatch.setattr(metricjoin, "cut", lambda d, name: tables.setdefault(name, plain(d, name)))
    metricjoin.op6(df).count()
    classes, cells = tables["classes"], tables["cells"]
    whole = sum(r.n * r.n for r in classes.groupBy("label").agg(F.count("*").alias("n")).collect())
    per = cells.groupBy("label", "cell").agg(F.count(F.when(F.col("inner"), 1)).alias("a"), F.count("*").alias("b")).collect()
    assert sum(r.a * r.b for r in per) < 0.95 * whole
    assert {r.label for r in classes.select("label").distinct().collect()} == {r.label for r in cells.where("cell > 0").select("label").distinct().collect()}


def test_rows_without_id_fill_many_parts(spark):
    """200,000 rows without an id: no part holds more than a few times its share, and the rows read back are those written."""
    rows = spark.range(200_000).select(F.lit(None).cast("long").alias("doc_id"), F.concat(F.lit("text "), (F.col("id") % 5000).cast("string")).alias("text"))
    seg = tokens.write_tokens(rows, tokens.default_tokenizer())
    per = [r.n for r in seg.groupBy("part").agg(F.sum(F.size("doc_ids")).alias("n")).collect()]
    parts = max(spark.sparkContext.defaultParallelism, 1)
    assert sum(per) == 200_000 and len(per) == parts and max(per) < 2 * 200_000 / parts
    got = tokens.read_tokens(seg)
    assert got.select("start").distinct().count() == 200_000 and got.groupBy("ids_crc32").count().agg(F.min("count"), F.max("count")).first() == (40, 40)
