"""Spelling variants, fill-in-middle and packing against brute force, with odd rows."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gridloom.llm import hilbert, infill, packing, spelling, trie

DOCS = "doc_id long, text string, n long, form string, key string, part int"


def make(spark, rows):
    """Extra columns have names that the operators use inside."""
    return spark.createDataFrame([(i, t, 7, "x", "k", 1) for i, t in rows], DOCS)


def texts(spark, sf):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]


# --- spelling variants --------------------------------------------------------------------


def distance_one(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    k = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    return a[k + 1:] == b[k + 1:] or a[k:] == b[k + 1:] or a[k + 1:] == b[k:]


def plain_variants(rows, drop=199):
    n = collections.Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % drop == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1:]
            n[run] += 1
    n = {w: k for w, k in n.items() if len(w) >= 6 and k >= 5}
    cut = collections.defaultdict(set)
    for w in n:
        for v in {w, *(w[:i] + w[i + 1:] for i in range(len(w)))}:
            cut[v].add(w)
    near = collections.defaultdict(set)
    for group in cut.values():
        for a in group:
            near[a] |= {b for b in group if distance_one(a, b)}
    form = {}
    for w in n:
        if near[w]:
            best = min(near[w], key=lambda v: (-n[v], v))
            if n[best] >= 5 * n[w]:
                form[w] = best
    out = {}
    for w in n:
        r = w
        while r in form:
            r = form[r]
        out[w] = (form.get(w), r, n[w], len(near[w]), n.get(form.get(w)))
    return out


def variants_of(df, **how):
    got = [(r.word, (r.form, r.root, r.n, r.n_near, r.form_n)) for r in spelling.variants(df, **how).collect()]
    assert len(got) == len(dict(got))
    return dict(got)


def test_variants_of_the_tables(spark, sf):
    assert variants_of(spark.read.parquet(f"{sf}/documents.parquet")) == plain_variants(texts(spark, sf))


def test_variants_of_odd_rows(spark):
    rng = random.Random(2)
    base = ["straßen", "königin", "window", "windows", "garden", "gardens", "æther×", "éééééé", "aaaaaa", "aaaaaaa", "aaaaaaaa", "short"]
    rows = []
    for i in range(400):
        words = [rng.choice(base) for _ in range(20)]
        words = [w if rng.random() < 0.8 else w[: (k := rng.randrange(len(w)))] + rng.choice("aenéßxZ") + w[k + rng.randrange(2):] for w in words]
        rows.append((None if i % 9 == 0 else i // 2, rng.choice([" ", ", ", "1", "ł", "\U0001f600"]).join(words)))
    rows += [(1, None), (2, ""), (3, "Window window " * 300_000), (4, "b" * 300_000 + " "), (5, ("c" * 2000 + " ") * 6 + ("c" * 2001 + " ") * 30)] * 2
    got = variants_of(make(spark, rows).repartition(5), drop=7)
    assert got == plain_variants(rows, drop=7)
    assert any(r[0] for r in got.values()) and any(r[1] != (r[0] or w) for w, r in got.items())
    assert variants_of(make(spark, [(1, None), (2, "a b")])) == {}


def test_variants_over_many_rounds(spark, sf, monkeypatch):
    """Shards and rounds of any size give the same rows."""
    want = plain_variants(texts(spark, sf))
    monkeypatch.setattr(spelling, "ROUND_BYTES", 2000)
    assert variants_of(spark.read.parquet(f"{sf}/documents.parquet")) == want


@settings(max_examples=60, deadline=None)
@given(st.sets(st.text("abé", min_size=1, max_size=6), min_size=1, max_size=60), st.lists(st.text("abé", min_size=1, max_size=6), max_size=30))
def test_trie_neighbours(words, asked):
    words = sorted(words)
    t = trie.Trie(trie.build([w.encode("latin-1") for w in words], np.arange(len(words)) + 1))
    assert [b.decode("latin-1") for b in t.spell(np.arange(len(words)))] == words
    assert t.counts.tolist() == list(range(1, len(words) + 1))
    got = {(int(a), int(b)) for x, y in t.neighbours([w.encode("latin-1") for w in asked]) for a, b in zip(x, y)}
    assert got == {(i, j) for i, a in enumerate(asked) for j, b in enumerate(words) if distance_one(a, b)}


# --- fill-in-middle -----------------------------------------------------------------------

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def plain_infill(doc, text):
    text = text or ""
    units = UNIT.findall(text)
    d = hashlib.sha256(f"42:{'' if doc is None else doc}".encode()).hexdigest()
    h = [int(d[8 * i:8 * i + 8], 16) for i in range(4)]
    n = len(units)
    same = hashlib.sha256(text.encode()).hexdigest()
    if text == "" or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return (doc, n, "plain", None, None, same, same)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    form = "spm" if h[3] % 100 < 80 else "psm"
    out = f"<S>{s}<P>{p}<M>{m}" if form == "spm" else f"<P>{p}<S>{s}<M>{m}"
    return (doc, n, form, len(p), len(m), hashlib.sha256(out.encode()).hexdigest(), same)


def test_infill_of_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(infill, "GROUP_IDS", 20)
    odd = [None, "", " ", "\n\t ", "a", " a ", "x<P>y", "<M>", "a < P> b", "a <P", "> b", "é ü x  y", "\U0001f600 \U0001f601\x0b z", "\x1c a\x1f", "a b " * 200_000, "q" * 400_000]
    rows = [(i * 100 + k, t) for k, t in enumerate(odd) for i in range(12)]
    rows += [(None, "the same text of no id"), (None, None)] * 90 + [(i, "one text that many share <S") for i in range(300)] + [(7, "twice the same row")] * 2
    got = [tuple(r) for r in infill.op12(make(spark, rows).repartition(6)).collect()]
    assert sorted(got, key=str) == sorted((plain_infill(*r) for r in rows), key=str)
    assert {r[2] for r in got} == {"plain", "psm", "spm"}


def test_index_holds_each_text_once(spark, monkeypatch):
    monkeypatch.setattr(infill, "GROUP_IDS", 50)
    rows = [(i, f"text {i % 40} of some words") for i in range(1600)] + [(None, "hot")] * 900
    index = infill.distinct_texts(make(spark, rows).repartition(7)).select("text", F.size("docs").alias("k"), "units.n").collect()
    per = collections.Counter(r.text for r in index)
    assert all(n == 1 for t, n in per.items() if t != "hot") and 10 < per["hot"] <= 18
    assert sum(r.k for r in index) == len(rows) and {r.n for r in index} == {1, 5}
    assert max(r.k for r in index) <= 2 * 50 + 50


# --- packing ------------------------------------------------------------------------------


def plain_word_ids(all_texts):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(packing.default_tokenizer())
    return [[*e.ids, 1] for e in t.encode_batch(all_texts, add_special_tokens=False)]


def check_pieces(got, want, size=2048):
    """got: rows of pieces; want: (doc_id, ids) of every row of the documents."""
    sequences = collections.defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append(r)
    for s in sequences.values():
        s.sort(key=lambda r: r.offset)
        assert [r.offset for r in s] == np.cumsum([0] + [r.length for r in s[:-1]]).tolist()
        n = sum(r.length for r in s)
        assert n == size or (n < size and n & (n - 1) == 0)
    # every row of the documents is covered once, also where rows are equal
    pieces = collections.Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in got)
    spans = collections.defaultdict(list)
    for r in got:
        spans[r.doc_id].append(r)
    for doc, ids in want:
        at, options = 0, spans[doc]
        while at < len(ids):
            fit = [r for r in options if r.start == at and r.doc_tokens == len(ids) and pieces[r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens] > 0
                   and zlib.crc32(np.array(ids[at:at + r.length], "<u4").tobytes()) == r.ids_crc32]
            assert fit, (doc, at)
            r = fit[0]
            pieces[r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens] -= 1
            at += r.length
        assert at == len(ids)
    assert not +pieces
    return sequences


def test_packing_of_the_tables(spark, sf):
    docs = texts(spark, sf)
    got = packing.op13(spark.read.parquet(f"{sf}/documents.parquet")).collect()
    want = [(d, ids) for (d, _), ids in zip(docs, plain_word_ids([t or "" for _, t in docs]))]
    sequences = check_pieces(got, want)
    # gapless numbers, and few sequences that are not full
    assert sorted(sequences) == list(range(len(sequences)))
    assert sum(1 for s in sequences.values() if sum(r.length for r in s) < 2048) <= 11 * 4


def test_packing_of_odd_rows(spark):
    odd = [None, "", " ", "a", "It's WE'LL  x", "<|endoftext|>", "x<|STARTOFTEXT|>y<|startoftext|>", "é ́ 한", "\x1c\x1f\x85 ", "ΣΑΣ İ ǅ ﬁ", "\U0001f600 123 4.5", "w" * 5000]
    rows = [(k, t) for k, t in enumerate(odd)] + [(None, "no id at all " * 40)] * 60 + [(5, "twice")] * 2
    rows += [(900, "the long text of many words, " * 120_000)]
    got = packing.op13(make(spark, rows).repartition(3)).collect()
    small = [(d, t) for d, t in rows if d not in (None, 900)]
    check = [r for r in got if r.doc_id not in (None, 900)]
    ids = dict(zip([t or "" for _, t in rows], plain_word_ids([t or "" for _, t in rows])))
    by = collections.defaultdict(int)
    for r in check:
        assert r.doc_tokens in {len(ids[t or ""]) for d, t in small if d == r.doc_id}
        by[r.doc_id] += r.length
    assert by == collections.Counter({d: sum(len(ids[t or ""]) for e, t in small if e == d) for d, _ in small})
    long = sorted((r for r in got if r.doc_id == 900), key=lambda r: r.start)
    whole = ids[rows[-1][1]]
    assert [r.start for r in long] == np.cumsum([0] + [r.length for r in long[:-1]]).tolist() and sum(r.length for r in long) == len(whole)
    assert all(zlib.crc32(np.array(whole[r.start:r.start + r.length], "<u4").tobytes()) == r.ids_crc32 for r in long)
    assert sum(r.length for r in got) == sum(len(ids[t or ""]) for _, t in rows)


@pytest.mark.parametrize("text", ["It's WE'LL", "éx ́y", "ΣΑΣ ος", "a b\x1cc\x85d", "1234 5,6", "x<|endoftext|>Y'S", "한국어 中文　字", "İstanbul ǅ ﬁ", "'re' \t've'"])
def test_words_encode_as_in_the_text(text):
    enc = packing.encoder(packing.default_tokenizer())
    assert np.frombuffer(enc.texts([text.encode()])[0], enc.dtype).tolist() + [1] == plain_word_ids([text])[0]


@settings(max_examples=100, deadline=None)
@given(st.text(max_size=60))
def test_any_text_encodes_as_by_the_library(text):
    text = text.encode("utf-8", "ignore").decode()
    enc = packing.encoder(packing.default_tokenizer())
    assert np.frombuffer(enc.texts([text.encode()])[0], enc.dtype).tolist() + [1] == plain_word_ids([text])[0]


@pytest.mark.parametrize("d, bits", [(2, 5), (3, 3), (4, 2)])
def test_curve_visits_every_point_in_steps_of_one(d, bits):
    points = np.stack(np.meshgrid(*[np.arange(1 << bits)] * d), -1).reshape(-1, d)
    keys = hilbert.keys(points, bits)
    assert sorted(keys.tolist()) == list(range(len(points)))
    path = points[np.argsort(keys)]
    assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def test_neighbours_on_the_curve_are_alike(spark):
    """Documents of one vocabulary share sequences: neighbours overlap far more than in the order of ids."""
    rng = random.Random(3)
    topics = [[f"t{k}w{i}" for i in range(60)] for k in range(6)]
    rows = [(i, " ".join(rng.choice(topics[i % 6]) for _ in range(200))) for i in range(300)]
    got = packing.op13(make(spark, rows)).collect()
    by = collections.defaultdict(set)
    for r in got:
        by[r.sequence_id].add(r.doc_id % 6)
    assert np.mean([len(t) for t in by.values()]) < 2
