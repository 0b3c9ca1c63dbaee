"""Token files: ids against whole-text encoding, order, starts, pruning, odd rows."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from webtide.llm import tokens

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def whole():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def encoder():
    with open(PATH, "rb") as f:
        return tokens.Encoder(f.read())


def _ids(whole, text):
    return np.array(whole.encode(text or "", add_special_tokens=False).ids, "<u4").tobytes()


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("ab Z.,'\n\t é 9 !ñß́")), max_size=40))
def test_pieces_give_whole_ids(text):
    from tokenizers import Tokenizer

    with open(PATH, "rb") as f:
        raw = f.read()
    assert _shared(raw)(text) == _ids(_model(), text)


_kept = {}


def _shared(raw):
    return _kept.setdefault("e", tokens.Encoder(raw)) if "e" not in _kept else _kept["e"]


def _model():
    if "m" not in _kept:
        from tokenizers import Tokenizer

        _kept["m"] = Tokenizer.from_file(PATH)
    return _kept["m"]


def test_added_token_and_long_word(whole, encoder):
    for text in ("x <|endoftext|> y", "<|endoftext|>", "a" * 5000, "word " * 3000, "  lead", "trail  ", "don't 's"):
        assert encoder(text) == _ids(whole, text)


def test_memory_of_pieces_is_bounded(whole, monkeypatch):
    monkeypatch.setattr(tokens, "_CACHE", 3)
    with open(PATH, "rb") as f:
        small = tokens.Encoder(f.read())
    text = "the cat and the dog and the cat saw a bird and the dog"
    assert small(text) == _ids(whole, text) and len(small._after_space) <= 3


def _expected(whole, rows):
    out, start = [], 0
    for doc_id, text in rows:
        ids = _ids(whole, text) + np.array([2], "<u4").tobytes()
        out.append((doc_id, start, len(ids) // 4, zlib.crc32(ids)))
        start += len(ids) // 4
    return out


def test_round_trip(spark, whole, tmp_path):
    rows = [(i, f"text number {i} says é {i * i}") for i in range(500)]
    rows += [(500, None), (501, ""), (502, "long " * 20000)]
    docs = spark.createDataFrame(rows[::-1], "doc_id long, text string").withColumnsRenamed({}).selectExpr("*", "'x' AS part", "1 AS ids")
    tokens.write_tokens(docs.repartition(5), str(tmp_path / "t"), PATH)
    back = tokens.read_tokens(spark, str(tmp_path / "t"))
    got = sorted(tuple(r) for r in tokens.digests(back).collect())
    assert got == _expected(whole, rows)
    ids = {r.doc_id: r.ids for r in back.collect()}
    assert ids[500] == [2] and np.array(ids[3], "<u4").tobytes()[:-4] == _ids(whole, rows[3][1])


def test_repeated_and_null_ids(spark, whole, tmp_path):
    rows = [(None, "n"), (1, "same"), (1, "same"), (1, "other"), (2, "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    tokens.write_tokens(docs, str(tmp_path / "t"), PATH)
    got = tokens.digests(tokens.read_tokens(spark, str(tmp_path / "t"))).collect()
    by_start = sorted(got, key=lambda r: r.start)
    assert [r.doc_id for r in by_start] == [None, 1, 1, 1, 2]
    assert all(a.start + a.n_tokens == b.start for a, b in zip(by_start, by_start[1:]))


def test_empty_table(spark, tmp_path):
    docs = spark.createDataFrame([], "doc_id long, text string")
    tokens.write_tokens(docs, str(tmp_path / "t"), PATH)
    assert tokens.read_tokens(spark, str(tmp_path / "t")).count() == 0


def test_files_are_pruned(spark, tmp_path):
    """A filter on doc_id reaches the files, and a file's Bloom filter and indexes are there."""
    from pyarrow import orc

    docs = spark.range(20000).selectExpr("id * 2 AS doc_id", "concat('t ', id) AS text")
    tokens.write_tokens(docs, str(tmp_path / "t"), PATH)
    plan = tokens.read_tokens(spark, str(tmp_path / "t")).filter("doc_id = 7")._jdf.queryExecution().toString()
    assert "PushedFilters: [IsNotNull(doc_id), EqualTo(doc_id,7)" in plan.replace("IsNotNull(part), ", "")
    files = sorted((tmp_path / "t" / "data").glob("*.orc"))
    firsts = [orc.ORCFile(f).read(columns=["doc_id"])[0][0].as_py() for f in files if orc.ORCFile(f).nrows]
    assert firsts == sorted(firsts)
    assert orc.ORCFile(files[0]).row_index_stride == 1000


_ODD_LETTERS = "abZé÷×ÿȿɀß 09²\n\n\n\t\r\x0b\x1c\x85\xa0\u1680\u2003\u2028\u3000'’s“.,!|_\x00\x7f漢ж́\U0001f600"


@settings(max_examples=400, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet=st.sampled_from(_ODD_LETTERS + "    "), max_size=30)), min_size=1, max_size=6))
def test_many_texts_at_once_give_whole_ids(texts):
    import pyarrow as pa

    with open(PATH, "rb") as f:
        encoder = _shared(f.read())
    # a slice of a longer array, as batches are cut
    got = encoder.lists(pa.array(["before it", *texts, "after it"])[1:-1], [2])
    assert [np.array(x, "<u4").tobytes() for x in got.to_pylist()] == [_ids(_model(), t) + np.array([2], "<u4").tobytes() for t in texts]


def test_many_texts_with_a_small_memory(whole, monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(tokens, "_CACHE", 5)
    with open(PATH, "rb") as f:
        small = tokens.Encoder(f.read())
    texts = [f"word{i} and don't\n\nsay <|endoftext|>" if i % 7 == 0 else f"word{i} été |a{i % 3}  b" if i % 5 == 0 else f"n{i}, so" for i in range(60)]
    for some in (texts[:30], texts[20:], texts[:1], [""], [None, ""], texts):
        assert [np.array(x, "<u4").tobytes() for x in small.lists(pa.array(some, pa.string()), []).to_pylist()] == [_ids(whole, t) for t in some]
        assert len(small._after_space) <= 5


def test_new_words_go_through_the_model_together(whole):
    """One call of the model for each new word took most of the time."""
    with open(PATH, "rb") as f:
        encoder = tokens.Encoder(f.read())
    model, calls = encoder._model, []
    encoder._model = lambda form: calls.append(form) or model(form)
    text = " ".join(f"qua{a}{b}{c}t" for a in "aeiouy" for b in "bcdfgh" for c in "lmnrs")
    assert encoder(text) == _ids(whole, text) and len(calls) <= 10
    assert encoder(text) == _ids(whole, text) and len(calls) <= 10


def test_a_tokenizer_without_a_byte_to_put_between(whole):
    with open(PATH, "rb") as f:
        encoder = tokens.Encoder(f.read())
    encoder._together = 1
    text = "one word at a time, été and don't\n\nnew“ones”"
    assert encoder(text) == _ids(whole, text)


def test_runs_of_spaces_do_not_send_whole_texts_through(whole):
    with open(PATH, "rb") as f:
        encoder = tokens.Encoder(f.read())
    text = "One sentence.  Another one. \n Then  　 more\n\n end  "
    encoder._whole = None
    assert encoder(text) == _ids(whole, text)
