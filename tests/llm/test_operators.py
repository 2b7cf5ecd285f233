"""Every operator on odd rows against plain Python, and on the small tables."""

from __future__ import annotations

import random

import pytest

from tests.llm import brute
from wickwork.llm import chat, debruijn, decontam, html, lines, mixing, near, suffix, topk, toxicity

DOC = "doc_id long, text string, lang string, source string, Spans int"


def odd_docs():
    """Nulls, empties, one very long text, copies, near copies, ties and passages in common."""
    rnd = random.Random(3)
    word = lambda: "".join(rnd.choice("abcdeéß") for _ in range(rnd.randint(1, 6)))
    passage = " ".join(word() for _ in range(60))
    base = [word() for _ in range(80)]
    rows = [(0, None, "en", "a", 1), (1, "", "en", None, 1), (2, " \n\t ", "en", "b", 1), (3, "one", "en", "a", 1), (4, "one", "en", "b", 1),
            (5, "x " * 30_000, "en", "c", 1), (6, "x " * 400, "en", "c", 1)]
    for i in range(7, 37):
        own = list(base)
        for _ in range(i % 6):
            own[rnd.randrange(80)] = word()
        text = " ".join(own)
        if i % 5 == 0:
            text = f"{' '.join(word() for _ in range(40))} {passage}\nshared line\n{text[: i * 3]}"
        rows.append((i, text, "en", f"s{i % 4}", 1))
    return rows


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(odd_docs(), DOC).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOC)


def plain():
    return [r[:4] for r in odd_docs()]


def got(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def test_near_duplicates(docs, none):
    assert got(near.near_duplicates(docs, width=2), "doc_id", "n_shingles", "component_id", "kept") == brute.near(plain())
    assert got(near.near_duplicates(docs), "doc_id", "n_shingles", "component_id", "kept") == brute.near(plain(), 5)
    assert near.near_duplicates(none).count() == 0
    kept = near.keep_one(docs.unionByName(docs))
    assert got(kept, "doc_id") == [(r[0],) for r in brute.near(plain(), 5) if r[3]]


def test_repeated_bytes(docs, none):
    from pyspark.sql import functions as F

    out = suffix.remove_repeated(docs).withColumn("sha", F.sha2("kept", 256))
    assert got(out, "doc_id", "n_bytes", "n_removed", "n_spans", "sha") == brute.repeated_bytes(plain())
    assert suffix.remove_repeated(none).count() == 0


def test_repeated_words(docs, none):
    from pyspark.sql import functions as F

    out = debruijn.remove_repeated(docs).withColumn("sha", F.sha2(F.encode("text", "utf-8"), 256))
    assert got(out, "doc_id", "n_words", "n_removed", "sha") == brute.repeated_words(plain())
    assert debruijn.remove_repeated(none).count() == 0


def test_rows_without_id_are_kept(spark):
    text = " ".join(f"w{i}" for i in range(80))
    docs = spark.createDataFrame([(None, text, "en", "a", 1), (None, text, "en", "a", 1), (1, text, "en", "a", 1)], DOC)
    assert [r.n_removed for r in debruijn.remove_repeated(docs).collect()] == [0, 0, 0]
    assert [r.n_removed for r in suffix.remove_repeated(docs).collect()] == [0, 0, 0]
    assert near.keep_one(docs).count() == 3
    assert decontam.clean(docs, docs.selectExpr("doc_id AS item_id", "text")).count() == 0


def test_decontamination(spark, docs, none):
    from pyspark.sql import functions as F

    items = [(1, None), (2, ""), (3, "One!"), (10, " ".join((odd_docs()[10][1]).split()[5:30])), (10, "x x x x x x x x x x"), (4, "never seen")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = decontam.decontaminate(docs, bench)
    listed = F.sha2(F.encode(F.array_join(F.array_sort(F.col("items").cast("array<string>")), ","), "utf-8"), 256)
    rows = got(found.select("doc_id", "n_words", "n_hit", F.size("items"), listed, F.col("n_hit") > 0), "*")
    assert rows == brute.decontaminated(plain(), items)
    assert decontam.decontaminate(none, bench).count() == 0
    assert decontam.clean(docs, bench.limit(0)).count() == docs.count()
    near_ = decontam.decontaminate(spark.createDataFrame([(1, "b x a"), (2, "a x x x b")], "doc_id long, text string"),
                                   spark.createDataFrame([(7, "a b")], "item_id long, text string"), span=3)
    assert got(near_, "doc_id", "items") == [(1, [7]), (2, [])]


def test_lines(spark, docs, none):
    from pyspark.sql import functions as F

    out = lines.dedupe_lines(docs, min_sites=2, counts=True)
    sha = F.sha2(F.encode(F.coalesce("text", F.lit("")), "utf-8"), 256)
    assert got(out.select("doc_id", "n_lines", "n_removed", sha), "*") == brute.lines(plain(), 2)
    assert out.columns[:5] == docs.columns
    assert lines.dedupe_lines(none).count() == 0


def test_mixing(docs, none):
    rows = mixing.mix(docs, block_words=1).collect()
    assert {(r.doc_id, r.taken) for r in rows} == {(r.doc_id, r.taken) for r in mixing.mix(docs, block_words=1).collect()}
    wanted = brute.targets(plain())
    for source, target in wanted.items():
        own = [r for r in rows if r.source == source]
        assert all(r.target == pytest.approx(target) and 0 <= r.taken <= 2 * r.size for r in own)
        assert abs(sum(r.taken for r in own) - target) <= 1
    assert mixing.mix(none).count() == 0


def test_apportionment_goes_to_the_highest_quotients(spark):
    weights = [53.0, 24.0, 23.0, 0.4, 24.0]
    shares = spark.createDataFrame([(w, 1000, i) for i, w in enumerate(weights)], "weight double, cap long, key long")
    quotients = sorted(((w / (2 * k + 1), -i) for i, w in enumerate(weights) for k in range(200)), reverse=True)[:37]
    won = {r.key: r.quota for r in mixing.apportion(shares, 37).collect()}
    assert won == {i: sum(-j == i for _, j in quotients) for i in range(len(weights))}


def test_top_k(spark):
    rnd = random.Random(1)
    vectors = [(i, [rnd.choice([-0.5, 0.25, rnd.gauss(0, 1)]) for _ in range(8)]) for i in range(300)]
    vectors += [(300, None), (301, [1.0, None]), (302, [float("nan")] * 8), (303, [float("inf")] * 8), (304, []), (305, [2.0])]
    df = topk.whole_vectors(spark.createDataFrame(vectors, "vec_id long, embedding array<float>"))
    padded = [(i, (v + [0.0] * 8)[:8] if v is not None and len(v) < 3 and None not in v else v) for i, v in vectors]
    import numpy as np

    single = [(i, v and [None if x is None else float(np.float32(x)) for x in v]) for i, v in padded]
    assert got(topk.top_k(df, df.where("id % 50 = 0")), "*") == brute.top_k(single)
    assert topk.top_k(df.limit(0), df.limit(0)).count() == 0


@pytest.mark.parametrize("text", ["", "<|im_end|>", "<\\|x", "<\\\\|<|", "a\\n<|im_start|>assistant\nok"])
def test_escapes_are_undone(text):
    assert chat.unescape(chat.escape(text)) == text and "<|" not in chat.escape(text)
    assert chat.unescape_role(chat.escape_role(text)) == text


def test_chats(spark):
    turns = [(1, 0, "system", "be kind"), *[(1, i, ("user", "assistant")[i % 2], f"turn {i} " * (i * 7)) for i in range(1, 30)],
             (1, 30, "assistant", "word " * 3000), (2, None, None, None), (2, 0, "assistant", "<|im_end|>"), (None, 1, "user", "x"), (3, 1, "user", "x"), (3, 1, "user", "x")]
    control = "<|im_end|><|im_start|>assistant ok"
    df = spark.createDataFrame([*turns, (-1, 0, "user", control), (-1, 1, "assistant", control)], "conv_id long, turn long, role string, text string")
    windows = chat.format_chats(df, budget=200, history=60)
    back = chat.read_back(windows).select("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256")
    assert sorted(map(tuple, back.collect()), key=repr) == brute.chats(turns)
    own = windows.where("conv_id = 1").orderBy("window").collect()
    assert len(own) > 3 and all("be kind" in w.formatted for w in own)
    assert all(w.n_tokens <= 200 or w.formatted.count(chat.START) - w.repeated == 1 for w in own)
    assert chat.format_chats(df.limit(0)).count() == 0


PAGE = """<html><head><title>no</title><style>p{}</style></head><body><header>Site</header><nav><ul><li><a href=x>Menu</a></ul></nav>
<div class="cookie-notice">We use cookies, as all others do.</div><article><h1>Title &amp; more</h1><p>First  text
of the article<br>goes on.<p>Second <b>para</b>graph.</p><div class="ad">Buy this now.</div><script>var t="</p>";</script>
<ul><li>An item of the article</li></ul><p>Last words.</p><section class="comments"><p>Nice comment by a reader of this page.</p></section></article>
<aside>Side</aside><form><p>Your name</p></form><footer>&copy; end</footer></body></html>"""


def test_main_text(spark):
    assert html.main_text(PAGE) == "Title & more\nFirst text of the article goes on.\nSecond paragraph.\nAn item of the article\nLast words."
    df = spark.createDataFrame([(1, None), (2, ""), (3, "<p>"), (4, PAGE)], "page_id long, html string")
    assert [r.text == "" for r in html.extract(df).orderBy("page_id").collect()] == [True, True, True, False]


LONG = "".join(f"<p>{'A long paragraph of the article, with many words in it. ' * 3}{i}</p>" for i in range(5))


@pytest.mark.parametrize("wrapper", [
    "<div class='has-sidebar'>{}</div>", "<div class='with-ads'><main>{}</main></div>", "<div id='menu-wrapper'>{}</div>",
    "<article class='cookie recipe'>{}</article>", "<div class='sidebar'><main>{}</main></div>", "<body><div>{}</div>",
])
def test_wrappers_do_not_hide_the_article(wrapper):
    page = f"<body><nav><a href=x>Menu</a></nav>{wrapper.format(LONG)}<article class='comment'><p>Nice work, and thank you.</p></article>"
    assert [line[-1] for line in html.main_text(page).split("\n")] == list("01234")


def test_short_pages_and_what_stands_in_a_line():
    assert html.main_text("<body><div><p>Short story here.</p></div>") == "Short story here."
    assert html.main_text("<nav><a href=x>Menu</a></nav><p>One</p><p><a href=y>Read more</a></p>") == "One"
    line = "<article><p>The formula <math><mi>x</mi><mo>=</mo><mn>1</mn></math> holds<script>var x = '<p>'</script>, <button>press</button> or <object>see</object> it.</p></article>"
    assert html.main_text(line) == "The formula x=1 holds, press or see it."
    assert html.main_text("<div class='sidebar'><p>a b</p></div><select><option>a<option>b</select>") == ""


def test_extract_of_no_pages(spark):
    pages = spark.createDataFrame([(1, "<p>One</p>", 5)], "page_id long, html string, text int")
    assert html.extract(pages.limit(0)).count() == 0 and html.extract(pages).first().text == "One"


def test_cut_is_minimal():
    rnd = random.Random(2)
    for _ in range(40):
        n = 6
        caps = [(a, b, rnd.randint(0, 9)) for a in range(n) for b in range(n) if a != b and rnd.random() < 0.5]
        graph = html.MinCut(n)
        for a, b, c in caps:
            graph.join(a, b, c)
        side = graph.source_side(0, n - 1)
        cost = lambda s: sum(c for a, b, c in caps if s[a] and not s[b])
        best = min(cost([True, *[bool(m >> i & 1) for i in range(n - 2)], False]) for m in range(1 << (n - 2)))
        assert cost(side) == best


def test_toxicity_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    model = toxicity.fit(docs, labels)
    rows = toxicity.score(docs, model).join(labels, "doc_id").where(toxicity.held_out()).select("score", "toxic").collect()
    assert sum((r.score >= 0.7) == r.toxic for r in rows) / len(rows) > 0.95
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "you idiot"), (4, "!!")], "doc_id long, text string")
    scores = [r.score for r in toxicity.score(odd, model).orderBy("doc_id").collect()]
    assert all(0 <= s <= 1 for s in scores) and scores[0] == scores[1] == scores[3] < scores[2]
    assert toxicity.clean(docs, labels.limit(0)).count() == docs.count()


def test_pipeline(spark):
    import corpus_pipeline

    out = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    assert out.columns == [*docs.columns, "size", "target", "taken"]
    assert 0 < out.count() <= docs.count() and out.select("doc_id").distinct().count() == out.count()


def test_copies_on_many_sources_stay_once(spark, tmp_path):
    import corpus_pipeline

    rnd = random.Random(5)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(6))
    page = lambda n: [" ".join(word() for _ in range(12)) for _ in range(n)]
    copied, edited, footer = page(6), page(40), "all rights reserved by the owner"
    rows = [(i, "\n".join(copied), "en", f"s{i:02}") for i in range(20)]
    for i in range(20):  # each copy has one line of its own
        rows.append((100 + i, "\n".join([*edited[:i], " ".join(word() for _ in range(12)), *edited[i + 1:]]), "en", f"s{i:02}"))
    rows += [(200 + i, "\n".join([*page(2), footer]), "en", f"s{i:02}") for i in range(20)]
    rows += [(None, "\n".join(page(1) if i else copied), "en", f"s{i:02}") for i in range(2)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    for table in ("labels", "benchmark"):
        spark.read.parquet(f"/root/testdata/sf0.001/{table}.parquet").limit(0).write.parquet(f"{tmp_path}/{table}.parquet")
    out = {r.doc_id: r.text for r in corpus_pipeline.run(spark, str(tmp_path)).where("doc_id IS NOT NULL").collect()}
    assert {i: t for i, t in out.items() if i < 200} == {0: rows[0][1], 100: rows[20][1]}
    assert len(out) > 10 and not any(footer in t for t in out.values())


def test_a_passage_in_many_contexts_is_not_one_group(spark, monkeypatch):
    from pyspark.sql import functions as F

    rnd = random.Random(7)
    letters = lambda n: "".join(rnd.choice("abcdefgh") for _ in range(n))
    passage = letters(120)
    rows = [(i, letters(60) + passage + letters(60), "en", "a") for i in range(150)]
    limit, plain_matched = 2048, suffix._matched

    def bounded(width):
        of = plain_matched(width)

        def checked(group):
            by_anchor = {}
            for h, piece in zip(group["h"].to_pylist(), group["piece"].to_pylist()):
                by_anchor[h] = by_anchor.get(h, 0) + len(piece)
            assert max(by_anchor.values()) <= limit, "one anchor whole in one task"
            return of(group)

        return checked

    monkeypatch.setattr(suffix, "GROUP_BYTES", limit)
    monkeypatch.setattr(suffix, "_matched", bounded)
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(3)
    out = suffix.remove_repeated(docs).withColumn("sha", F.sha2("kept", 256))
    assert got(out, "doc_id", "n_bytes", "n_removed", "n_spans", "sha") == brute.repeated_bytes(rows)


CLASHES = "n_lines int, n_removed int, _at int, _id int, _v int, size int, target int, taken int, score int, _score int, _own_score int, _hit int, _gone int"


def test_columns_of_any_name_are_kept(spark):
    """Documents with columns of the names that the operators use inside or add."""
    names = [c.split()[0] for c in CLASHES.split(", ")]
    texts = [None, "", "one line\nand more", "one line\nof text here", "one line\nby another"]
    rows = [(i, t, "en", f"s{i}", *range(len(names))) for i, t in enumerate(texts)] + [(None, "one line", "en", None, *range(len(names)))]
    wide = spark.createDataFrame(rows, f"doc_id long, text string, lang string, source string, {CLASHES}")
    plain_docs = wide.select("doc_id", "text", "lang", "source")
    labels = spark.createDataFrame([(2, 0, 0), (3, 0, 1)], "doc_id long, quality int, toxic int")
    bench = spark.createDataFrame([(1, "more")], "item_id long, text string")

    def same(of, added=()):
        got, wanted = of(wide), of(plain_docs)
        assert sorted(map(tuple, got.select(*wanted.columns).collect()), key=repr) == sorted(map(tuple, wanted.collect()), key=repr)
        assert sorted(got.columns) == sorted({*wide.columns, *added})

    import corpus_pipeline

    same(lambda d: lines.dedupe_lines(d, min_sites=2))
    same(lambda d: lines.dedupe_lines(d, min_sites=2, counts=True), ("n_lines", "n_removed"))
    same(lambda d: toxicity.clean(d, labels))
    same(near.keep_one)
    same(lambda d: decontam.clean(d, bench))
    same(lambda d: corpus_pipeline.mix_sources(spark, d, ""), ("size", "target", "taken"))
    assert sorted(map(tuple, mixing.mix(wide).collect()), key=repr) == sorted(map(tuple, mixing.mix(plain_docs).collect()), key=repr)
    assert {r.held for r in wide.select(toxicity.held_out().alias("held")).collect()} <= {True, False}
    assert toxicity.score(plain_docs.limit(0), toxicity.fit(plain_docs.limit(0), labels)).count() == 0


def test_texts_without_words_pass_no_window(spark, monkeypatch):
    docs = spark.createDataFrame([(i, None if i % 2 else " ", "a") for i in range(50)] + [(100, "x y z", "a"), (101, "", "b")], "doc_id long, text string, source string")
    rows = mixing.mix(docs, block_words=1).collect()
    assert len(rows) == 52 and all(r.taken == 0 and r.size == 0 for r in rows if r.doc_id != 100)
    [one] = [r for r in rows if r.doc_id == 100]
    assert (one.size, one.source_size, one.target, one.taken) == (3, 3, 4.5, pytest.approx(4.5, abs=1))


def test_rest_round_tells_large_sets_apart():
    """400 unlike sets of 5,000 shingles and a few that are linked, in one bucket, without a look at all pairs of sets."""
    import time

    import numpy as np

    rng = np.random.default_rng(5)
    sets = [np.unique(rng.integers(0, 1 << 63, 5000, dtype=np.uint64)) for _ in range(400)]
    close = sets[7].copy()
    close[:500] = rng.integers(0, 1 << 63, 500, dtype=np.uint64)  # 4,500 of 5,500: above 0.8
    far = sets[7].copy()
    far[-600:] = rng.integers(0, 1 << 63, 600, dtype=np.uint64)  # 4,400 of 5,600: below
    sets += [np.unique(close), np.unique(far), sets[9][:4000], sets[9][:3999]]  # 0.8 exactly, and just below
    ids, side = np.arange(404), np.zeros(404, np.int64)
    began = time.perf_counter()
    found = near.links_between(ids, ids, side, sets, 80)
    assert time.perf_counter() - began < 1
    assert {tuple(sorted(x)) for x in found} == {(7, 400), (9, 402), (402, 403)}
    side[[7, 9]] = 1
    found = near.links_between(ids, ids, side, sets, 80)
    assert {tuple(sorted(x)) for x in found} == {(7, 400), (9, 402)}


def test_rest_round_equals_all_pairs(monkeypatch):
    import numpy as np

    rng = np.random.default_rng(6)
    base = [np.unique(rng.integers(0, 1 << 63, int(n), dtype=np.uint64)) for n in rng.integers(1, 900, 12)]
    sets = []
    for i in range(120):
        own = base[i % 12]
        sets.append(np.unique(np.r_[own[rng.random(len(own)) < 0.95], own[:1], rng.integers(0, 1 << 63, i % 40, dtype=np.uint64)]))
    root = np.array([rng.integers(i + 1) if i % 3 == 0 else i for i in range(120)])

    def joined(links):
        name = root.copy()
        for a, b in links:
            name[name == name[b]] = name[a]
        return {frozenset(np.flatnonzero(name == x).tolist()) for x in name}

    def linked(p, q):
        both = len(np.intersect1d(p, q))
        return 100 * both >= 80 * (len(p) + len(q) - both)

    pairs = [(i, j) for i in range(120) for j in range(i) if linked(sets[i], sets[j])]
    found = near.links_between(np.arange(120), root, np.zeros(120, int), sets, 80)
    assert {tuple(sorted(x, reverse=True)) for x in found} <= set(pairs)
    assert joined(found) == joined(pairs)


def test_buckets_are_cut_by_bytes(docs, monkeypatch):
    """Chunks of a few members or of a few bytes give the same components."""
    monkeypatch.setattr(near, "CHUNK_BYTES", 700)
    assert got(near.near_duplicates(docs, width=2), "doc_id", "n_shingles", "component_id", "kept") == brute.near(plain())


def test_phrases_over_two_terms_in_bounded_memory(monkeypatch):
    """A thousand phrases whose rarest term stands at every second place."""
    import itertools
    import random as rnd
    import tracemalloc

    import numpy as np

    lists = [np.array(x) for x in itertools.islice(itertools.product([10, 20], repeat=10), 1, 1023)]
    chosen = rnd.Random(2)
    words = np.array([chosen.choice([10, 20]) for _ in range(20_000)])
    terms = np.array([10, 20])
    places = {t: np.flatnonzero(words == terms[t]).astype(np.int32) for t in (0, 1)}
    phrases = decontam.Phrases(terms, np.arange(len(lists)), lists, np.array([len(places[0]), len(places[1])]))
    monkeypatch.setattr(decontam, "AT_ONCE", 1 << 14)
    tracemalloc.start()
    phrase, start = phrases.matches(places, len(words))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 8 << 20
    index = {tuple(x.tolist()): i for i, x in enumerate(lists)}
    wanted = {(index[w], at) for at in range(len(words) - 9) if (w := tuple(words[at: at + 10].tolist())) in index}
    assert set(zip(phrase.tolist(), start.tolist())) == wanted


def test_items_without_an_id_are_one_item(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, "c"), (3, "d")], "doc_id long, text string")
    items = spark.createDataFrame([(None, "a b"), (None, "c"), (-1, "d"), (4, "c")], "item_id long, text string")
    assert sorted((r.doc_id, r["items"]) for r in decontam.decontaminate(docs, items).collect()) == [(1, [None]), (2, [None, 4]), (3, [-1])]


def test_longest_previous_factors():
    """Against all pairs of suffixes, on texts of few letters with long repeats."""
    import numpy as np

    rnd = random.Random(19)
    for width in (8, 13, 21):
        passage = "".join(rnd.choice("ab") for _ in range(60))
        texts = [passage[rnd.randrange(20): rnd.randrange(30, 60)] + "".join(rnd.choice("ab") for _ in range(25)) for _ in range(9)]
        texts += [texts[0], "a" * 60, "a" * 50]
        docs = [rnd.randrange(8) for _ in texts]
        at, doc, base = [], [], 0
        for text, d in zip(texts, docs):
            n = len(text) - width + 1
            at += range(base, base + n)
            doc += [d] * n
            base += len(text)
        whole = "".join(texts)
        parts = [whole[i: i + width] for i in at]
        data, at, doc = np.frombuffer(whole.encode(), np.uint8), np.array(at), np.array(doc)
        order, common = suffix.suffix_array(data, at, doc, width)
        assert order.tolist() == sorted(range(len(at)), key=lambda i: (parts[i], doc[i], i))

        def shared(a, b):
            return next((n for n, (x, y) in enumerate(zip(a, b)) if x != y), len(a))

        assert common.tolist() == [0] + [shared(parts[a], parts[b]) for a, b in zip(order, order[1:])]
        plain = [max((shared(parts[i], parts[j]) for j in range(len(at)) if doc[j] < doc[i]), default=0) for i in range(len(at))]
        assert suffix.longest_previous(order, common, doc).tolist() == plain
        for least in (5, width):
            cut = [n if n >= least else 0 for n in plain]
            assert suffix.longest_previous(order, common, doc, least).tolist() == cut
    none = np.empty(0, np.int64)
    assert suffix.longest_previous(*suffix.suffix_array(np.empty(0, np.uint8), none, none, 8), none).tolist() == []


def test_long_texts_are_read_in_pieces(spark, monkeypatch):
    """Segments of bytes and words do not depend on the pieces, also with words longer than a piece."""
    import numpy as np
    import pyarrow as pa

    from wickwork.llm import spans

    rnd = random.Random(23)
    word = lambda: "".join(rnd.choice("abé") for _ in range(rnd.choice([1, 2, 3, 3, 4, 900])))
    texts = [" ".join(word() for _ in range(n)) for n in (3000, 20, 700)] + [None, "", "ab " * 4000, "x" * 9000]
    column = pa.array(texts, pa.string())
    for units, width, k in ((suffix._bytes, 50, 18), (debruijn._words, 50, 10), (debruijn._words, 6, 2)):
        def found(size):
            monkeypatch.setattr(spans, "PIECE_BYTES", size)
            monkeypatch.setattr(spans.tokens, "SLICE_BYTES", size)
            return sorted(
                item for row, h, start, begin, end, hashes in spans._pieces(column, units, width, k)
                for item in zip(row.tolist(), start.tolist(), (end - begin).tolist(), h.tolist(), hashes.of(begin, end + width - 1).tolist())
            )

        assert found(1 << 20) == found(1000) == found(411)

    for _ in range(200):
        starts, counts = np.array([rnd.randrange(40) for _ in range(rnd.randrange(6))], np.int64), None
        counts = np.array([rnd.randint(1, 9) for _ in starts], np.int64)
        plain = np.zeros(50, bool)
        for a, n in zip(starts, counts):
            plain[a: a + n + 4] = True
        assert spans.covered_units((starts, counts), 50, 5).tolist() == plain.tolist()

    rows = [(i, t, "en", "a") for i, t in enumerate(texts + [texts[0][500:4000] + " end", texts[2]])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(2)
    assert got(debruijn.remove_repeated(docs).selectExpr("doc_id", "n_words", "n_removed", "sha2(text, 256) AS sha"), "doc_id", "n_words", "n_removed", "sha") == brute.repeated_words(rows)
    out = suffix.remove_repeated(docs).selectExpr("*", "sha2(kept, 256) AS sha")
    assert got(out, "doc_id", "n_bytes", "n_removed", "n_spans", "sha") == brute.repeated_bytes(rows)
