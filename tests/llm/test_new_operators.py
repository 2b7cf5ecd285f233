"""Quality classifier, spelling variants and ranked search against plain Python."""

from __future__ import annotations

import random

import numpy as np
import pytest

from tests.llm import brute
from wickwork.llm import quality, search, spelling

SF = "/root/testdata/sf0.001"
DOC = "doc_id long, text string, word string, score int, n int, terms string"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def odd_docs():
    rnd = random.Random(11)
    base = ["".join(rnd.choice("abcdeÉßÿ") for _ in range(rnd.randint(5, 12))) for _ in range(60)]

    def word():
        w = rnd.choice(base)
        if rnd.random() < 0.3:
            at = rnd.randrange(len(w))
            w = w[:at] + rnd.choice(["", "a", "E", "ab", "×"]) + w[at + rnd.randint(0, 1):]
        return w

    texts = [None, "", "  ", "12 !!", "ÀÀÀÀÀÀÀÀ ÀÀÀÀÀÀÀÀ", "Straßešabcdefgh abcdefgh一abcdefgh", "x" * 300, "x" * 300, "x" * 299 + " " + "x" * 299]
    texts += [" ".join(word() for _ in range(rnd.randint(1, 80))) for _ in range(60)]
    made = [(i, t, "w", 1, 2, "t") for i, t in enumerate(texts)]
    return made + made[20:23] + [(None, texts[15], "w", 1, 2, "t")]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(odd_docs(), DOC).repartition(3)


@pytest.mark.parametrize("subtree", [1 << 14, 8])
def test_spelling_variants(docs, monkeypatch, subtree):
    monkeypatch.setattr(spelling, "SUBTREE_WORDS", subtree)  # one task, or many subtrees
    for factor in (10, 2):
        assert rows(spelling.group_variants(docs, factor=factor)) == brute.spellings(odd_docs(), factor=factor)


def test_spelling_variants_of_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    plain = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    assert rows(spelling.group_variants(docs)) == brute.spellings(plain)
    assert spelling.group_variants(docs.limit(0)).count() == 0


def test_runs_are_cut_anywhere(monkeypatch):
    text = "Abcdefgh, ijklmnop " * 20 + "q" * 50 + " abcdefgh"
    whole = spelling.runs(text)
    for size in (1, 7, 30):
        monkeypatch.setattr(spelling, "_PIECE", size)
        assert spelling.runs(text) == whole


def test_pairs_are_found_in_bounded_pieces(monkeypatch):
    monkeypatch.setattr(spelling, "_PAIRS", 3)
    rnd = random.Random(5)
    words = sorted({"".join(rnd.choice("ab") for _ in range(rnd.randint(7, 9))).encode() for _ in range(200)})
    found = spelling.Subtree(words, np.ones(len(words), bool)).pairs()
    wanted = {(i, j) for i, a in enumerate(words) for j, b in enumerate(words) if i < j and spelling.one_edit(a, b)}
    assert {tuple(sorted(p)) for p in found.T.tolist()} == wanted and found.shape[1] == len(wanted)


@pytest.mark.parametrize("shards, blocks", [(1 << 20, 1 << 18), (40, 6)])
def test_search(spark, docs, monkeypatch, shards, blocks):
    monkeypatch.setattr(search, "SHARD_POSTINGS", shards)
    texts = [t for _, t, *_ in odd_docs() if t and len(t) > 20]
    items = [(1, None), (2, ""), (3, texts[8]), (4, texts[9].upper()), (4, texts[10]), (None, texts[11]), (5, "none of these words"), (6, "x" * 300)]
    asked = spark.createDataFrame(items, "item_id long, text string")
    for k in (3, 50):
        assert rows(search.search(docs, asked, k=k, block_terms=blocks)) == brute.searched([r[:2] for r in odd_docs()], items, k)
    assert search.search(docs.limit(0), asked).count() == 0
    assert search.search(docs, asked.limit(0)).count() == 0


def test_terms_are_cut_anywhere(monkeypatch):
    text = ("Abc, déf1 " * 30 + "q" * 50).encode()
    whole = search.count_terms(text)
    for size in (1, 6, 29):
        monkeypatch.setattr(search, "_PIECE", size)
        assert search.count_terms(text) == whole


def test_search_stops_before_the_lists_end():
    rnd = np.random.default_rng(3)
    docs, terms = 20_000, 4
    doc = np.concatenate([np.sort(rnd.choice(docs, 8000, replace=False)) for _ in range(terms)])
    term, tf = np.repeat(np.arange(terms), 8000), rnd.integers(1, 2000, 8000 * terms)
    shard = search.Shard(np.full(docs, 100), doc, term, tf, np.array([9000, 700, 500, 100]), docs, 100 * docs)
    found, scores, looked_up = shard.top(np.arange(terms), 10)
    whole = np.zeros(docs, np.int64)
    np.add.at(whole, shard.doc, shard.impact)
    best = np.lexsort((np.arange(docs), -whole))[:10]
    assert looked_up < docs / 2
    assert [int(d) for d in found[np.lexsort((found, -scores))[:10]]] == best.tolist()


def test_quality_scores_match_plain_loops():
    rnd = np.random.default_rng(1)
    network = quality.Network(rnd.normal(size=(quality.WIDTH, 256, quality.FILTERS)).astype(np.float32), rnd.normal(size=quality.FILTERS), rnd.normal(size=quality.FILTERS), 0.3)
    texts = [b"", b"a", b"abc " * 40, bytes(rnd.integers(0, 256, 700).astype(np.uint8)), b"", b"x" * 128, b"y" * 129]

    def plain(raw):
        raw, total = raw + bytes(quality.WIDTH if not raw else quality.WIDTH - 1), 0.0
        n = len(raw) - quality.WIDTH + 1
        for lo in range(0, n, quality.CHUNK):
            hi = min(lo + quality.CHUNK, n)
            largest = np.max([sum(network.tables[w, raw[i + w]] for w in range(quality.WIDTH)) for i in range(lo, hi)], axis=0)
            total += float(np.tanh(largest + network.offsets) @ network.weights) * (hi - lo)
        return total / n + 0.3

    offsets = np.cumsum([0, *map(len, texts)])
    for piece in (64, 1 << 15):
        quality._PIECE, before = piece, quality._PIECE
        got = network.logits(np.frombuffer(b"".join(texts), np.uint8), offsets)
        quality._PIECE = before
        assert got == pytest.approx([plain(t) for t in texts], abs=1e-4)


def test_quality_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    network = quality.fit(docs, labels)
    got = quality.score(docs, network).join(labels, "doc_id").where(quality.held_out()).select("score", "quality").collect()
    assert sum((r.score >= 0.5) == r.quality for r in got) / len(got) > 0.95
    odd = spark.createDataFrame([(1, None, 7), (2, "", 7), (2, "", 7), (None, "x" * 300_000, 7)], "doc_id long, text string, score int")
    scored = quality.score(odd, network).select(quality.held_out().alias("h"), "score").collect()
    assert all(0 <= r.score <= 1 and r.h is not None for r in scored) and scored[0].score == scored[1].score == scored[2].score
    blank = quality.fit(docs, labels.limit(0))
    assert {r.score for r in quality.score(docs.limit(5), blank).collect()} == {0.5}
    assert quality.score(docs.limit(0), network).count() == 0 and quality.fit(docs.limit(0), labels).bias == 0
