"""The random field: exact probabilities, learned languages, odd texts."""

import zlib

import numpy as np
import pytest

from webtide.llm import langid

SMALL = langid.Training(per_language=60, steps=60)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet("/root/testdata/sf0.01/documents.parquet")


@pytest.fixture(scope="module")
def model(docs):
    return langid.learn(docs, SMALL)


def naive(model, scores):
    k, n = scores.shape[1], len(scores)
    f, b = np.zeros((n, k)), np.zeros((n, k))
    f[0] = model.start + scores[0]
    for t in range(1, n):
        f[t] = np.log(np.exp(f[t - 1][:, None] + model.transitions).sum(0)) + scores[t]
    for t in range(n - 2, -1, -1):
        b[t] = np.log(np.exp(model.transitions + scores[t + 1] + b[t + 1]).sum(1))
    x = np.exp(f + b - (f + b).max(1, keepdims=True))
    return x / x.sum(1, keepdims=True)


def test_posteriors(model):
    rng = np.random.default_rng(1)
    at = np.array([0, 1, 1, 33, 65, 65, 200])
    scores = rng.normal(size=(200, len(model.languages))) * 2
    got = langid.posteriors(model, scores, at)
    for a, b in zip(at[:-1], at[1:]):
        if b > a:
            assert np.abs(got[a:b] - naive(model, scores[a:b])).max() < 1e-9


def test_held_out(docs, model):
    got = {r.doc_id: r for r in langid.predict(docs, model).collect()}
    rows = [r for r in docs.select("doc_id", "lang").collect() if zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    right = sum(got[r.doc_id].lang_pred == r.lang for r in rows)
    assert len(got) == docs.count() and right / len(rows) > 0.98
    assert all(0 <= r.score <= 1 for r in got.values())


def test_nothing_held_out_is_learned(docs):
    from pyspark.sql import functions as F

    other = docs.withColumn("lang", F.when(langid.held_out(F.col("doc_id")), F.lit("xx")).otherwise(F.col("lang")))
    assert "xx" not in langid.sample(other, SMALL)[1]
    assert langid.sample(other, SMALL) == langid.sample(docs, SMALL)


def test_code_switched(docs, model):
    """Words of a text that changes its language in the middle are labelled by halves."""
    rows = docs.filter("length(text) > 1500").select("text", "lang").collect()
    first = {x: next(r.text for r in rows if r.lang == x)[:1200] for x in ("fr", "de")}
    from webtide.llm.words import LETTERS, split
    import pyarrow as pa

    w = langid.letters_only(split(pa.array([first["fr"] + "\n" + first["de"]]), LETTERS))
    p = langid.posteriors(model, model.emissions(w, w.hashes()), w.at).argmax(1)
    n = len(langid.letters_only(split(pa.array([first["fr"]]), LETTERS)).start)
    names = np.array(model.languages)[p]
    assert (names[:n] == "fr").mean() > 0.95 and (names[n:] == "de").mean() > 0.95


def test_odd_texts(spark, model):
    rows = [(1, None), (2, ""), (3, "12 34 !?"), (4, "— … “” ١٢"), (5, "the " * 60000), (None, "the of and"), (6, "der"), (6, "der")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'z' AS lang_pred", "1 AS key")
    got = langid.predict(df, model).collect()
    assert len(got) == 8
    assert {r.doc_id for r in got if r.lang_pred == "und"} == {1, 2, 3, 4}
    assert all(r.score == 0 for r in got if r.lang_pred == "und")
    assert {r.lang_pred for r in got if r.doc_id in (5, None)} == {"en"} and {r.lang_pred for r in got if r.doc_id == 6} == {"de"}
    kept = langid.accepted(df, model)
    assert kept.columns == df.columns and sorted((r.doc_id or 0) for r in kept.collect()) == [0, 5, 6, 6]
    assert langid.predict(df.limit(0), model).count() == 0


def test_nothing_to_learn(spark):
    df = spark.createDataFrame([(1, "abc", None), (3, "def", None)], "doc_id long, text string, lang string")
    got = langid.predict(df, langid.learn(df)).collect()
    assert [(r.lang_pred, r.score) for r in got] == [("und", 0.0)] * 2


def test_label_without_words(spark, docs, model):
    """A label that only texts without letters have is no language; the others are learned as if it were not there."""
    odd = [(i, text, "zxx") for i, text in enumerate(["", "12 34", "!? …", "٣٤ — 5", "000"] * 20, 10**6)]
    more = docs.select("doc_id", "text", "lang").unionByName(spark.createDataFrame(odd, "doc_id long, text string, lang string"))
    assert "zxx" not in langid.sample(more, SMALL)[1]
    got = langid.learn(more, SMALL)
    assert got.languages == model.languages and np.array_equal(got.weights, model.weights) and model.weights.any()
    texts, labels = langid.sample(docs, SMALL)
    plain, got = langid.fit(texts, labels, SMALL), langid.fit([*texts, "12"], [*labels, "zxx"], SMALL)
    assert got.languages == plain.languages and np.array_equal(got.weights, plain.weights)


def test_long_labelled_texts(spark):
    """A language whose documents are all longer than `chars` is learned from passages of them."""
    settings = langid.Training(per_language=20, chars=300, steps=30)
    long = [(i, "7 " * 400 + "kuru sani talo mida " * 300, "xa") for i in range(40)]
    rows = spark.createDataFrame(long + [(i, "bore gliv strum nask", "xb") for i in range(100, 140)], "doc_id long, text string, lang string")
    texts, labels = langid.sample(rows, settings)
    assert set(labels) == {"xa", "xb"} and all(len(x) <= 300 for x in texts)
    assert all(x.startswith("kuru") for x, y in zip(texts, labels) if y == "xa")
    got = langid.predict(rows, langid.fit(texts, labels, settings)).collect()
    assert all(r.lang_pred == ("xa" if r.doc_id < 100 else "xb") for r in got)


def test_pieces_hold_every_byte():
    """Long words are cut between characters; whatever is in them counts, also behind the first bytes."""
    import pyarrow as pa
    from webtide.llm.words import LETTERS, split

    texts = ["", "short words", "長い文章は空白なしで書かれています" * 40, "x" * 1000, "й" * 13 + " й", "ภาษาไทยไม่มีช่องว่าง" * 9, "a" * 24, "𝒳" * 31]
    w = langid.pieces(split(pa.array(texts), LETTERS))
    assert len(w.start) == w.at[-1] and (w.end - w.start).max() <= langid._SPAN and (w.end > w.start).all()
    for i, text in enumerate(texts):
        got = [w.bytes[a:b].tobytes().decode() for a, b in zip(w.start[w.at[i] : w.at[i + 1]], w.end[w.at[i] : w.at[i + 1]])]
        assert "".join(got) == text.lower().replace(" ", "")
        assert len(text.encode()) > 24 or got == text.split()


def test_unspaced_scripts(spark):
    """Texts that differ only behind a long common beginning without spaces are told apart."""
    same = "語" * 40
    rows = [(i, same + ("山川" if i % 2 else "かな") * 30, "xa" if i % 2 else "xb") for i in range(120)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = langid.predict(docs, langid.learn(docs, langid.Training(per_language=30, steps=40))).collect()
    assert all(r.lang_pred == ("xa" if r.doc_id % 2 else "xb") for r in got)


def test_hot_id_and_dirty_labels(spark, docs):
    """20,000 rows under one doc_id, alike or not, and 10,000 labels: the sample stays bounded and no language is lost."""
    clean = docs.select("doc_id", "text", "lang")
    hot = next(i for i in range(10**7, 10**7 + 9) if zlib.crc32(str(i).encode()) % 4 != 2)
    many = clean.filter("lang = 'en'").limit(20).selectExpr(f"{hot}L AS doc_id", "explode(transform(sequence(1, 1000), i -> concat(text, ' ', i))) AS text", "lang")
    alike = spark.range(20_000).selectExpr(f"{hot}L AS doc_id", "'the very same text' AS text", "'fr' AS lang")
    dirty = spark.range(10_000).selectExpr("id + 20000000 AS doc_id", "'kuru sani' AS text", "concat('l', id) AS lang")
    settings = langid.Training(languages=12, per_language=60, steps=60)
    texts, labels = langid.sample(clean.unionByName(many).unionByName(alike).unionByName(dirty), settings)
    known = {r.lang for r in clean.filter("lang IS NOT NULL").select("lang").distinct().collect()}
    assert len(set(labels)) == 12 and known <= set(labels)
    assert labels.count("en") == 60 and labels.count("fr") == 60 and texts.count("the very same text") <= 1


def test_lexicons_count_all_documents(spark):
    """Equal to plain counts over all documents that may be learned from, ties by hash, and held-out ones have no say."""
    import pyarrow as pa
    from webtide.llm.words import LETTERS, split

    rng = np.random.default_rng(5)
    names = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(60)]
    rows = [(i, " ".join(rng.choice(names, 12)), ["xa", "xb", None][i % 3]) for i in range(200)] + [(900, None, "xa"), (901, "12 !", "xa"), (None, "wzz", "xa")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(5)
    hashed = dict(zip(names, split(pa.array(names), LETTERS).hashes().tolist()))
    for size in (1, 7, 1000):
        got = langid.lexicons(docs, ["xa", "xb"], size)
        for lang in ("xa", "xb"):
            n = {}
            for i, text, x in rows:
                if x == lang and text and i is not None and zlib.crc32(str(i).encode()) % 4 != 2:
                    for word in text.split():
                        if word in hashed:
                            n[hashed[word]] = n.get(hashed[word], 0) + 1
            signed = lambda v: v - (1 << 64) if v >> 63 else v
            assert set(got[lang]) == set(sorted(n, key=lambda v: (-n[v], signed(v)))[:size])
    assert langid.lexicons(docs.limit(0), ["xa"], 5) == {"xa": []} and langid.lexicons(docs, [], 5) == {}


def test_driver_holds_little_more_than_the_texts(docs, monkeypatch):
    """Only the documents learned from come to the driver, and fitting holds no numbers per byte or features of all words."""
    import tracemalloc

    came, collect = [], type(docs).collect
    with monkeypatch.context() as m:
        m.setattr(type(docs), "collect", lambda df: (rows := collect(df), came.append(len(rows)))[0])
        _, labels = langid.sample(docs, langid.Training(per_language=5))
    assert max(came) == len(labels) == 5 * len(set(labels))

    rng = np.random.default_rng(3)
    texts = [" ".join(f"w{chr(97 + c % 26)}x{chr(97 + c // 26 % 26)}{chr(97 + c // 676 % 26)}" for c in rng.integers(17_576, size=6000).tolist()) for _ in range(160)]
    size = sum(map(len, texts))
    tracemalloc.start()
    langid.fit(texts, ["xa", "xb"] * 80, langid.Training(steps=1, lexicon=10), {"xa": [], "xb": []})
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 20 * size + (70 << 20)  # so much for a slice and the model
