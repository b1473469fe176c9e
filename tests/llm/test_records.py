import zlib

import numpy as np
import public_tokenizers as P
import pytest
from fareweave.llm import records as R
from tokenizers import Tokenizer

PATH = P.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)
TEXTS = ["so it goes", "", None, "line\nfeeds\r\n\n", "it's <|endoftext|> here<|endoftext|>", "日本 \U0001f600", "w " * 60_000, "x"]


def wanted(rows):
    start, out = 0, []
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    for doc_id, text in order:
        ids = [*LIBRARY.encode(text or "", add_special_tokens=False).ids, 0]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


@pytest.mark.parametrize("file_text", [32_000_000, 2_000])
def test_round_trip(spark, tmp_path, file_text):
    rows = [(i * 7 % 101, TEXTS[i % len(TEXTS)]) for i in range(100)] + [(None, "no id")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as id", "2 as tie").repartition(4)
    folder = str(tmp_path / "out")
    R.write_records(docs, folder, PATH, file_text=file_text)
    index = R.read_index(spark, folder)
    found = R.read_records(spark, folder)
    both = found.join(index.select("file", "row", "start"), ["file", "row"]).collect()
    assert sorted([(r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in both], key=lambda r: r[1]) == wanted(rows)
    files = {r.file for r in both}
    assert (len(files) > 3) == (file_text == 2_000)
    shuffled = R.read_shuffled(spark, folder, seed=1).collect()
    assert [r.doc_id for r in shuffled] != [r.doc_id for r in R.read_shuffled(spark, folder, seed=2).collect()]
    assert sorted((str(r.doc_id), tuple(r.ids)) for r in shuffled) == sorted((str(r.doc_id), tuple(r.ids)) for r in both)
    some = R.read_shuffled(spark, folder, index.where("doc_id % 2 = 0")).collect()
    assert {r.doc_id for r in some} == {i for i, _ in rows if i is not None and i % 2 == 0}


def test_repeated_rows(spark, tmp_path):
    rows = [(3, "same")] * 50 + [(3, "other"), (1, "a")]
    folder = str(tmp_path / "out")
    R.write_records(spark.createDataFrame(rows, "doc_id long, text string"), folder, PATH, file_text=20)
    got = R.read_index(spark, folder).orderBy("start").collect()
    assert [r.doc_id for r in got] == [1, *[3] * 51]
    ends = np.cumsum([r.n_tokens for r in got])
    assert [r.start for r in got] == [0, *ends[:-1].tolist()]


def test_broken_files_are_an_error():
    data = R.frame(5, np.array([1, 2, 3], np.uint16)) + b"\n" + R.frame(None, np.array([9], np.uint32)) + b"\n"
    found = [R.payload(data, at, size) for at, size in R.lengths(data)]
    assert [(n, ids.tolist()) for n, ids in found] == [(5, [1, 2, 3]), (None, [9])]
    for at in range(len(data)):
        broken = data[:at] + bytes([data[at] ^ 1]) + data[at + 1 :]
        with pytest.raises(R.BadRecord):
            for place, size in R.lengths(broken):
                R.payload(broken, place, size)
    with pytest.raises(R.BadRecord):
        list(R.lengths(data[:-3]))


def test_empty_table(spark, tmp_path):
    folder = str(tmp_path / "out")
    R.write_records(spark.createDataFrame([], "doc_id long, text string"), folder, PATH)
    assert R.read_index(spark, folder).count() == 0 and R.read_records(spark, folder).count() == 0


def test_query(spark):
    from fareweave.llm.queries import QUERIES

    folder = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    got = QUERIES["op10_records"](spark, folder).collect()
    assert sorted(((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in got), key=lambda r: r[1]) == wanted(rows)
