"""The transducer against the sentencepiece library, and exact round trips."""

import random

import pytest
import sentencepiece

from cinerank.llm import pieces
from tests.llm.conftest import prose


@pytest.fixture(scope="module")
def model():
    return pieces.load()


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(15)
    alphabet = "abcdetion  \n▁\t éßñ中文🙂\x00​<s>'"
    out = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 70))) for _ in range(400)]
    out += ["".join(rng.choice(["ab", "the", " "]) + " " * rng.randint(0, 40) for _ in range(rng.randint(1, 6))) for _ in range(100)]
    return out + [prose(rng, rng.randint(1, 200)) for _ in range(60)] + [
        "", " ", "  ", "<s>", "</s> <unk> <0x0A>", "ab" * 300, "▁▁ ▁", "\n\n", " \n ", "I'm — naïve “q” 12.5 foo_bar==(); // x"]


def test_equals_library(model, texts):
    library = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL_PATH)
    for t in texts:
        ids = model.encode(t).tolist()
        assert ids == library.encode(t), t
        assert model.decode(ids) == t.replace("▁", " ")


def test_blocks_do_not_change_results(model, texts, monkeypatch):
    import pyarrow as pa

    want = model.encode_all(pa.array([None, *texts, None]))
    assert want[0].as_py() is None and want[1].as_py() == model.encode(texts[0]).tolist()
    monkeypatch.setattr(pieces, "BLOCK_BYTES", 16)
    assert model.encode_all(pa.array(["cut off", None, *texts, None]).slice(1)).equals(want)


def test_arcs_weigh_zero_exactly_if_merging_gives_both(model):
    rng = random.Random(16)
    normal = [i for i, t in enumerate(model.model.types) if t == pieces.NORMAL]
    pool = [i for i in normal if model._merge(model.model.pieces[i]) == [model.model.pieces[i]]]
    pairs = [(rng.choice(pool), rng.choice(pool)) for _ in range(2000)] + [(i, i) for i in pool[::40]]
    for text in ("aaaa", "abab", "tttt", "inin", "thethe", "eeeee", "▁" * 16):  # equal merges side by side
        pairs += [(model.arc[text[:k]], model.arc[text[k:j]]) for j in range(2, len(text) + 1) for k in range(1, j)
                  if text[:k] in model.arc and text[k:j] in model.arc]
    pairs = [p for p in pairs if p[0] in pool and p[1] in pool]
    got = model.may_follow(pieces.np.array([a for a, _ in pairs]), pieces.np.array([b for _, b in pairs]))
    for (a, b), zero in zip(pairs, got.tolist()):
        two = [model.model.pieces[a], model.model.pieces[b]]
        assert zero == (model._merge("".join(two)) == two), two


def test_text_without_blanks_is_one_segment(model):
    library = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL_PATH)
    rng = random.Random(17)
    text = "".join(rng.choice("abcdeinorst") for _ in range(40_000))
    assert model.encode(text).tolist() == library.encode(text)


def test_decode_of_any_bytes(model):
    bytes_ = [model.byte[0xE4], model.byte[0xB8]]
    assert model.decode(bytes_) == "\ufffd" and model.decode([]) == ""


def test_unigram_weights_take_the_shortest_path():
    model = pieces.PieceModel.__new__(pieces.PieceModel)
    model.pieces = ["<unk>", "▁", "a", "b", "ab", "▁a", "bb"]
    model.scores = [0.0, -1.0, -2.0, -2.0, -2.5, -2.6, -3.9]
    model.types = [pieces.UNKNOWN] + [pieces.NORMAL] * 6
    model.kind, model.prefix = pieces.UNIGRAM, True
    own = pieces.Transducer(model)
    assert [model.pieces[i] for i in own.encode("abb")] == ["▁", "ab", "b"]  # 5.5, against 6.5 for ▁a bb
    assert own.encode("é").tolist() == [1, 0]  # no byte pieces: unknown


def test_frames(spark, docs, model):
    rows = [(1, None), (2, ""), (3, "Hello world"), (3, "Hello world"), (None, "a\nb"), (4, "long " * 20000)]
    df = docs(rows, extra=True)
    coded = pieces.encode(df, model)
    assert coded.columns == df.columns + ["ids"]
    back = pieces.decode(coded, model)
    assert sorted(map(repr, pieces.round_trip(df, model).collect())) == sorted(map(repr, back.collect()))
    got = sorted(((r.doc_id, r.text, r.ids is None, r.decoded) for r in back.collect()), key=repr)
    assert got == sorted(((i, t, t is None, t) for i, t in rows), key=repr)
    assert [r.ids for r in coded.filter("doc_id = 2").collect()] == [[]]
    assert pieces.encode(docs([]), model).collect() == []
    clash = pieces.encode(docs([(1, "a")]).withColumnRenamed("lang", "ids"), model)
    assert clash.columns.count("ids") == 2 and clash.collect()[0][-1] == model.encode("a").tolist()
