"""Token files: an exact round trip, what the files look like inside, and selective reads."""

import glob
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tripmart.llm.queries import QUERIES
from tripmart.llm.tokenfiles import SegmentEncoder, checksums, read_metadata, read_tokens, write_tokens

PATH = public_tokenizers.path("byte_bpe_50k.json")


def expected(rows):
    """(doc_id, start, ids) in ascending id order, null last."""
    tokenizer = Tokenizer.from_file(PATH)
    out, start = [], 0
    for i, t in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 2]
        out.append((i, start, ids))
        start += len(ids)
    return out


def found(df):
    return [(r.doc_id, r.start, r.ids) for r in df.orderBy("start").collect()]


def crc(ids):
    return zlib.crc32(np.array(ids, dtype="<u4").tobytes())


def test_supplied_documents(spark):
    sf_dir = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    got = QUERIES["op12_token_files"](spark, sf_dir).orderBy("start").collect()
    assert [tuple(r) for r in got] == [(i, s, len(x), crc(x)) for i, s, x in expected(rows)]


def test_segments_are_cut_where_the_tokenizer_cuts():
    rng = random.Random(5)
    parts = ["'s", "'", "'ll", "It", "é", "É", ".", "***", "—", "9", "12", " ", " ", " ", "\n", "\n", "\t", "a", "Z"]
    parts += ["<|endoftext|>", "<|", "|>", "　", "\x85", " ", "\xa0", " ", "漢", "\x00", "\x1c", "\x7f", "​"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(0, 25))) for _ in range(3000)]
    texts += ["", " ", "\n", " a", "a ", "a\n", "\na", "a b", "a\nb", "a\n b", "a \nb", "x" * 50_000]
    tokenizer = Tokenizer.from_file(PATH)
    encode = SegmentEncoder(PATH)
    raw = [t.encode() for t in texts]
    data = np.frombuffer(b"".join(raw), np.uint8)
    ids, count = encode(data, np.append(0, np.cumsum([len(x) for x in raw])))
    got = np.split(ids, np.cumsum(count)[:-1])
    for text, one in zip(texts, got, strict=True):
        assert one.tolist() == tokenizer.encode(text, add_special_tokens=False).ids, repr(text)


def edge_rows():
    rows = [(7, None), (3, ""), (5, " \n "), (-2, "It's <|endoftext|> 12 ÉÀ don't"), (9, "the " * 30_000)]
    return [*rows, (11, "same"), (11, "same"), (None, "no id"), (None, None), (1 << 40, "a\x0bb  c")]


@pytest.mark.parametrize("encoding", ["dictionary", "delta"])
def test_edges(spark, tmp_path, encoding):
    rows = edge_rows()
    df = spark.createDataFrame([(*r, 0, "x") for r in rows], "doc_id long, text string, start int, part string")
    path = str(tmp_path / "files")
    write_tokens(df.repartition(3), path, PATH, encoding=encoding)
    got = found(read_tokens(spark, path))
    want = expected(rows)
    assert [r[0] for r in got] == [r[0] for r in want]
    # Rows of equal id may come in any order of their texts; all else is fixed.
    assert sorted((str(i), x) for i, _, x in got) == sorted((str(i), x) for i, _, x in want)
    start = 0
    for _, at, ids in got:
        assert at == start
        start += len(ids)
    digests = checksums(read_tokens(spark, path)).collect()
    assert sorted(r.ids_crc32 for r in digests) == sorted(crc(x) for _, _, x in want)
    empty = str(tmp_path / "empty")
    write_tokens(df.where("false"), empty, PATH, encoding=encoding)
    assert read_tokens(spark, empty).count() == 0 and read_metadata(spark, empty).count() == 0
    with pytest.raises(ValueError):
        write_tokens(df, str(tmp_path / "other"), PATH, encoding="plain")


@pytest.mark.parametrize("encoding", ["dictionary", "delta"])
def test_files_hold_indexes_and_encodings(spark, tmp_path, encoding):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    path = str(tmp_path / "files")
    write_tokens(docs, path, PATH, encoding=encoding, row_group_bytes=1 << 18, page_bytes=1 << 14, page_rows=32)
    groups = 0
    for name in glob.glob(f"{path}/data/*.parquet"):
        meta = pq.ParquetFile(name).metadata
        groups += meta.num_row_groups
        for g in range(meta.num_row_groups):
            group = meta.row_group(g)
            for c in range(group.num_columns):
                column = group.column(c)
                assert column.has_column_index and column.has_offset_index
                if column.path_in_schema.startswith("ids"):
                    used = set(column.encodings)
                    assert used & ({"RLE_DICTIONARY"} if encoding == "dictionary" else {"DELTA_BINARY_PACKED"}), used
    assert groups > 2 * len(glob.glob(f"{path}/data/*.parquet"))


def test_selective_reads(spark, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    path = str(tmp_path / "files")
    write_tokens(docs, path, PATH)
    want = expected([tuple(r) for r in docs.collect()])
    total = want[-1][1] + len(want[-1][2])

    some = read_tokens(spark, path, first_id=100, last_id=110)
    assert found(some) == [r for r in want if 100 <= r[0] <= 110]
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(doc_id,100)" in plan and "LessThanOrEqual(doc_id,110)" in plan

    for first, past in [(0, 1), (5000, 9000), (total - 1, total), (total, total + 5)]:
        hit = [r for r in want if r[1] < past and r[1] + len(r[2]) > first]
        assert found(read_tokens(spark, path, first=first, past=past)) == hit

    meta = read_metadata(spark, path)
    assert [tuple(r) for r in meta.orderBy("start").collect()] == [(i, s, len(x)) for i, s, x in want]
    assert "ids" not in meta.select(F.sum("n_tokens"))._jdf.queryExecution().executedPlan().toString().split("ReadSchema")[1]
