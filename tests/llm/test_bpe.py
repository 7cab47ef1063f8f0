import random

import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import types as T
from tokenizers import Tokenizer

from tidemark.llm import bpe

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(PATH)
    t.no_truncation()
    t.no_padding()
    return t


def texts():
    r = random.Random(11)
    out = [None, "", " ", "\n\t ", "Hello world", "HELLO, World!!", "don't we'll I'm they'RE", "12345 3.14 a1b2", "naïve café ÉÀ",
           "é combining", "ΣΑΣ Σ", "İstanbul ǅ ß", "日本語のテキスト", "🙂👍🏽 emoji", " nbsp em　wide", "a\x1cb\x1fc",
           "<|startoftext|>x<|endoftext|>", "< | <| |> <|start", "x" * 3000, "na" * 2000, "​zero‍width", "a\x00b", "ﬁ ﬂ Ⅷ ①"]
    alphabet = "abcdeABC  \n\t'’.,!?-_0123éßñüΣ日本🙂<|> ́ "
    out += ["".join(r.choice(alphabet) for _ in range(r.randint(1, 60))) for _ in range(400)]
    out += [" ".join("".join(r.choice("etaoinshrdlu") for _ in range(r.randint(1, 14))) for _ in range(60)) for _ in range(20)]
    return out


def test_equals_the_library(spark, library):
    rows = [(i, t, "x") for i, t in enumerate(texts())]
    docs = spark.createDataFrame(rows, "doc_id int, text string, decoded string")
    back = bpe.decode_bpe(bpe.encode_bpe(docs, PATH), PATH).collect()
    assert len(back) == len(rows)
    one = {r["doc_id"]: (r["ids"], r["decoded"]) for r in bpe.round_trip_bpe(docs, PATH).collect()}
    assert one == {r["doc_id"]: (r["ids"], r["decoded"]) for r in back}
    for r in back:
        want = library.encode(r["text"] or "", add_special_tokens=False).ids
        assert r["ids"] == want, repr(r["text"])
        assert r["decoded"] == library.decode(want, skip_special_tokens=False), repr(r["text"])


def test_a_full_cache_changes_nothing(library, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_WORDS", 10)
    encoder = bpe.Encoder(bpe.read_spec(PATH))
    for t in texts()[:150]:
        flat, _ = encoder.encode([t])
        assert flat.tolist() == library.encode(t or "", add_special_tokens=False).ids


def test_decoding_odd_ids(spark):
    docs = spark.createDataFrame([(1, None), (2, []), (3, [-1, 513, 10 ** 9]), (4, [None, 513])], "doc_id int, ids array<int>")
    got = {r["doc_id"]: r["decoded"] for r in bpe.decode_bpe(docs, PATH).collect()}
    assert got[1] == got[2] == "" and got[3] == got[4] != ""


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id int, text string")
    assert bpe.decode_bpe(bpe.encode_bpe(docs, PATH), PATH).count() == 0


def test_every_code_point(library):
    """Each assigned or unassigned character, alone and between letters, splits as in the library."""
    encoder = bpe.Encoder(bpe.read_spec(PATH))
    points = [chr(c) for c in (*range(0x80, 0x3000), *range(0xA000, 0xB000), *range(0xF900, 0x11800), *range(0x16A00, 0x18D00),
                               *range(0x1B000, 0x1B300), *range(0x1D000, 0x1F000)) if not 0xD800 <= c < 0xE000]
    lines = ["".join(f" a{c}b1{c}" for c in points[i:i + 64]) for i in range(0, len(points), 64)]
    flat, ends = encoder.encode(lines)
    for line, a, b, want in zip(lines, ends, ends[1:], library.encode_batch(lines, add_special_tokens=False)):
        if flat[a:b].tolist() != want.ids:
            bad = [f"U+{ord(c):04X}" for c in line if encoder.encode([f"a{c}b1{c}"])[0].tolist()
                   != library.encode(f"a{c}b1{c}", add_special_tokens=False).ids]
            assert not bad, bad


def test_another_normalizer_raises():
    spec = bpe.read_spec(PATH)
    with pytest.raises(ValueError, match="normalizer"):
        bpe.Encoder(spec | {"normalizer": {"type": "NFD"}})


def test_encoding_leaves_out_cycle_searches_and_turns_them_on_again(spark, monkeypatch):
    import gc
    seen = []

    class Watched(bpe.Encoder):
        def encode(self, texts):
            seen.append(gc.isenabled())
            return super().encode(texts)
    monkeypatch.setattr(bpe, "Encoder", Watched)
    sent = {}

    class Holder:
        schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("text", T.StringType())])
        columns = ["id", "text"]
        sparkSession = spark

        def mapInArrow(self, work, schema):
            sent["work"] = work
    monkeypatch.setattr(bpe, "small_batches", lambda df: df)
    bpe.round_trip_bpe(Holder(), PATH)
    batch = pa.RecordBatch.from_pydict({"id": [1, 2], "text": ["one two", None]})
    out = list(sent["work"](iter([batch])))
    assert sum(b.num_rows for b in out) == 2 and seen and not any(seen) and gc.isenabled()
