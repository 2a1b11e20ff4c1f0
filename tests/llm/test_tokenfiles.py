import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from docquery.llm import queries, tokenfiles, wordids
from docquery.llm.queries import vocabulary

PATH = vocabulary("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def odd_texts(n, seed=4):
    rng = random.Random(seed)
    some = list(" \n\t\x1c\x85　'sÀßàİσΣ.,!12²é漢😀́_-J̸̇̌>=(") + ["<|endoftext|>", "<|startoftext|>", "The", "é", "'re", "'S"]
    return ["".join(rng.choice(some) for _ in range(rng.randint(0, 20))) for _ in range(n)]


@pytest.mark.parametrize("closing", [None, 1])
def test_ids_equal_library(library, closing):
    encoder = wordids.WordIds(PATH)
    texts = [None, "", " ", *odd_texts(2000), "x" * 100_000, None]
    ids, bounds = encoder.encode(pa.array(texts, pa.string()), closing)
    wanted = library.encode_batch([t or "" for t in texts], add_special_tokens=False)
    for i, want in enumerate(wanted):
        assert ids[bounds[i] : bounds[i + 1]].tolist() == want.ids + ([] if closing is None else [closing]), texts[i]
    assert encoder.encode(pa.array([], pa.string()), closing)[1].tolist() == [0]


def test_memory_is_bounded(library, monkeypatch):
    monkeypatch.setattr(wordids, "MEMORY_BYTES", 20_000)
    encoder = wordids.WordIds(PATH)
    rng = random.Random(1)
    for _ in range(20):
        texts = [f"the word{rng.randint(0, 10**9)} of abc{'x' * rng.randint(0, 9)}" for _ in range(50)]
        ids, bounds = encoder.encode(pa.array(texts))
        for i, want in enumerate(library.encode_batch(texts, add_special_tokens=False)):
            assert ids[bounds[i] : bounds[i + 1]].tolist() == want.ids
        assert encoder.bytes < 80_000


def test_other_vocabulary_is_refused():
    with pytest.raises(ValueError, match="one by one"):
        wordids.WordIds(vocabulary("byte_bpe_50k.json"))


def wanted_rows(library, rows):
    """Brute force: every document in order of its key, with the library's ids and the end id."""
    start, wanted = 0, []
    for key, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = library.encode(text or "", add_special_tokens=False).ids + [1]
        wanted.append((key, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return wanted


def test_query_equals_brute_force(spark, data, library):
    rows = [tuple(r) for r in spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text").collect()]
    got = queries.op11_orc_token_files(spark, data)
    assert [f.dataType.simpleString() for f in got.schema] == ["bigint"] * 4
    assert sorted(map(tuple, got.collect())) == wanted_rows(library, rows)


def test_odd_rows(spark, library, tmp_path):
    rows = [(9, None), (9, None), (None, "a b"), (3, ""), (-5, "long " * 30_000), (3, ""), (8, "<|endoftext|> b")]
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, ids string, part int")
    tokenfiles.write_token_files(docs.repartition(3), PATH, f"{tmp_path}/t")
    got = tokenfiles.id_checksums(tokenfiles.read_token_files(spark, f"{tmp_path}/t")).collect()
    assert sorted(map(tuple, got), key=lambda r: r[1]) == wanted_rows(library, rows)


def test_empty_table(spark, tmp_path):
    docs = spark.createDataFrame([], "doc_id long, text string")
    tokenfiles.write_token_files(docs, PATH, f"{tmp_path}/t")
    assert tokenfiles.id_checksums(tokenfiles.read_token_files(spark, f"{tmp_path}/t")).count() == 0
    assert tokenfiles.read_span(spark, f"{tmp_path}/t", 0, 10).count() == 0


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = f"{tmp_path_factory.mktemp('files')}/t"
    rng = random.Random(2)
    rows = [(2 * i, " ".join(rng.choice("alpha beta gamma delta".split()) for _ in range(40))) for i in range(20_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    kept = tokenfiles.STRIPE_BYTES
    tokenfiles.STRIPE_BYTES = 1 << 17
    tokenfiles.write_token_files(docs, PATH, path)
    tokenfiles.STRIPE_BYTES = kept
    return path


def test_indexes_and_stripes(spark, stored):
    """The files have several stripes, row indexes of the stated stride, and Bloom filters on keys alone."""
    jvm = spark._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    folder = jvm.org.apache.hadoop.fs.Path(f"file://{stored}/files")
    names = [str(f.getPath()) for f in folder.getFileSystem(conf).listStatus(folder)]
    found = 0
    for name in names:
        if not name.endswith(".orc"):
            continue
        reader = jvm.org.apache.orc.OrcFile.createReader(
            jvm.org.apache.hadoop.fs.Path(name), jvm.org.apache.orc.OrcFile.readerOptions(conf)
        )
        assert reader.getRowIndexStride() == tokenfiles.STRIDE
        assert reader.getStripes().size() > 1
        rows = reader.rows()
        for stripe in reader.getStripes():
            streams = rows.readStripeFooter(stripe).getStreamsList()
            kinds = {(s.getColumn(), str(s.getKind())) for s in streams}
            assert {c for c, k in kinds if k.startswith("BLOOM_FILTER")} == {1}
            assert {c for c, k in kinds if k == "ROW_INDEX"} >= {1, 2, 3, 4, 5}
            encodings = [str(c.getKind()) for c in rows.readStripeFooter(stripe).getColumnsList()]
            assert encodings[6] == "DIRECT_V2"
        rows.close()
        found += 1
    assert found == 2
    spark.conf.set("spark.sql.files.maxPartitionBytes", 1 << 16)
    try:
        read = tokenfiles.read_token_files(spark, stored)
        assert read.rdd.getNumPartitions() > 2 and read.count() == 20_000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_lookup_reads_few_rows(spark, stored):
    found = tokenfiles.find_documents(spark, stored, [4, 7, 39_998])
    assert re.search(r"PushedFilters: \[[^\n]*In\(key", found._jdf.queryExecution().executedPlan().toString())
    rows = found.collect()
    assert sorted(r["doc_id"] for r in rows) == [4, 39_998]
    nodes, scanned = [found._jdf.queryExecution().executedPlan()], []
    while nodes:
        node = nodes.pop()
        if node.nodeName() == "AdaptiveSparkPlan":
            node = node.executedPlan()
        if node.nodeName().endswith("QueryStage"):
            node = node.plan()
        if node.nodeName().startswith("Scan orc") and "ids" in node.toString():
            scanned.append(node.metrics().apply("numOutputRows").value())
        children = node.children()
        nodes += [children.apply(i) for i in range(children.size())]
    assert scanned and max(scanned) <= 2 * tokenfiles.STRIDE


def test_span(spark, stored):
    every = tokenfiles.read_token_files(spark, stored).orderBy("start").select("ids").collect()
    flat = [i for r in every for i in r["ids"]]
    for first, last in ((0, 1), (40, 43), (len(flat) // 2 - 500, len(flat) // 2 + 500), (len(flat) - 3, len(flat) + 9)):
        rows = tokenfiles.read_span(spark, stored, first, last).orderBy("start").collect()
        assert rows[0]["start"] == first
        assert [i for r in rows for i in r["ids"]] == flat[first:last]
    assert tokenfiles.read_span(spark, stored, len(flat), len(flat) + 1).count() == 0


def test_ids_written_as_integers(spark, stored):
    assert spark.read.orc(f"{stored}/files").schema["ids"].dataType.simpleString() == "array<int>"
    assert spark.read.orc(f"{stored}/manifest").agg(F.sum("documents")).head()[0] == 20_000
