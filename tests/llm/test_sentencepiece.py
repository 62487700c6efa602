import random

import pytest
import sentencepiece

from icuflow.llm import queries
from icuflow.llm import sentencepiece_codec as S


@pytest.fixture(scope="module")
def lib():
    return sentencepiece.SentencePieceProcessor(model_file=S.MODEL)


def texts(n=1500):
    rnd = random.Random(4)
    v = S.vocabulary(S.MODEL)
    out = ["", " ", "  ", "   a  b ", "\n\n\t x", "a" * 40, "<s> </s>", "<0x41>", "日本語テスト 😀😀", "é" * 50, "ababababab" * 20, "-" * 100, "=" * 33 + " " * 45]
    for _ in range(n):
        k = rnd.random()
        if k < 0.4:
            out.append("".join(rnd.choice(v.pieces[3:]).replace(S.MARK, " ") for _ in range(rnd.randint(1, 8))))
        elif k < 0.7:
            out.append("".join(rnd.choice("abcdeinorst \n-=.") for _ in range(rnd.randint(1, 40))))
        else:
            out.append("".join(chr(rnd.choice([rnd.randint(32, 126), rnd.randint(160, 1200), rnd.randint(0x4E00, 0x4F00)])) for _ in range(rnd.randint(1, 20))))
    return out


def test_equals_the_library(lib):
    e, ts = S.Encoder(S.vocabulary(S.MODEL)), texts()
    ids = e.encode(ts)
    assert ids == [lib.encode(t) for t in ts]
    assert [S.decode_ids(e.v, x) for x in ids] == [lib.decode(x) for x in ids]


def test_full_cache_changes_nothing(monkeypatch, lib):
    monkeypatch.setattr(S, "CACHE_WORDS", 3)
    monkeypatch.setattr(S, "CELLS", 64)
    e, ts = S.Encoder(S.vocabulary(S.MODEL)), texts(100)
    assert [e.encode([t])[0] for t in ts] == [lib.encode(t) for t in ts]


def test_query_equals_the_library_on_the_driver_table(spark, lib):
    import hashlib
    sf = "/root/testdata/sf0.001"
    got = {r["doc_id"]: r for r in queries.op2_sentencepiece(spark, sf).collect()}
    for doc, text in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect():
        ids = lib.encode(text)
        assert got[doc]["n_tokens"] == len(ids)
        assert got[doc]["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert got[doc]["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_empty_table_nulls_repeated_rows_and_extra_columns(spark):
    assert S.digest(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    df = spark.createDataFrame([(1, None, 0), (2, "", 0), (3, "a b", 0), (3, "a b", 0), (None, "x" * 30000, 0)], "doc_id long, text string, ids int")
    rows = S.encode(df).collect()
    assert sorted((r["doc_id"] or 0, r["ids"] and len(r["ids"]) > 0) for r in rows) == [(0, True), (1, None), (2, []), (3, True), (3, True)]
    assert [r["n_tokens"] for r in S.digest(df).orderBy("doc_id").collect()][1:3] == [0, 0]
    out = S.tokenize(df.drop("ids").withColumnRenamed("doc_id", "n")).collect()
    assert sorted(r["round_trip"] for r in out if r["text"] is not None) == [True] * 4


def test_text_without_spaces_equals_the_library_and_takes_no_longer(lib):
    """Long runs of one script: ids of the library, in at most twice the time of spaced words of as many bytes."""
    import time
    rnd = random.Random(9)
    v = S.vocabulary(S.MODEL)
    chinese = ["".join(chr(rnd.randint(0x4E00, 0x9FA5)) for _ in range(20_000)) for _ in range(3)]
    known = [p for p in v.pieces if len(p) == 1 and ord(p) > 0x3000]
    mixed = ["".join(rnd.choice(known) if rnd.random() < 0.5 else rnd.choice("abcABC。、.-😀é") for _ in range(5000)) for _ in range(3)]
    hard = ["a" * 3000, "ab" * 2000, "The" * 1500, "的" * 4000, "a" * 40 + "\n" * 40 + "日本" * 40]
    spaced = [" ".join("".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rnd.randint(2, 9))) for _ in range(10_000)) for _ in range(3)]
    assert S.Encoder(v).encode(chinese + mixed + hard) == [lib.encode(t) for t in chinese + mixed + hard]

    def seconds(ts):
        best = 1e9
        for _ in range(3):
            e, t0 = S.Encoder(v), time.process_time()
            e.encode_raw(ts)
            best = min(best, time.process_time() - t0)
        return best

    assert seconds(chinese) <= 2 * seconds(spaced)


def test_other_kinds_of_models_are_refused():
    def message(kind, normaliser=b"\x20\x00"):
        trainer = b"\x18" + bytes([kind])
        return b"\x12" + bytes([len(trainer)]) + trainer + b"\x1a" + bytes([len(normaliser)]) + normaliser

    S.check_kind(message(2))
    for bad in (message(1), message(3), b"", message(2, b""), message(2, b"\x20\x01"), message(2, b"\x20\x00\x12\x01x")):
        with pytest.raises(ValueError):
            S.check_kind(bad)
