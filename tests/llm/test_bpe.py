import random

import numpy as np
import pytest

from docquery.llm import bpe
from docquery.llm.queries import vocabulary

PATH = vocabulary("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def both():
    from tokenizers import Tokenizer

    return bpe.Encoder(bpe.load_tables(PATH)), Tokenizer.from_file(PATH)


def same(both, text):
    encoder, reference = both
    ids = reference.encode(text, add_special_tokens=False).ids
    got = encoder.encode(text)
    assert np.frombuffer(got, "<u4").tolist() == ids, text
    assert encoder.decode(got) == reference.decode(ids, skip_special_tokens=False)


def test_odd_characters(both):
    rng = random.Random(1)
    some = list(" \n\t\r\x0b\x0c\x1c\x1f\x85\xa0  ​　'’sdtrvml.,!aaabbnoieeTHE123²½éß漢😀́")
    some += ["<|endoftext|>", "'s", "'ll", "  ", "the", "ing", " a"]
    for _ in range(3000):
        same(both, "".join(rng.choice(some) for _ in range(rng.randint(0, 25))))


def test_random_words_and_runs(both):
    rng = random.Random(2)
    for _ in range(2000):
        same(both, "".join(rng.choice("abcdefghinoprstuvw") for _ in range(rng.randint(1, 30))))
    for run in ("a", "ab", " ", "=", "0", "é"):
        same(both, run * 5000)


def test_corpus_equals_library(both, spark, data):
    for row in spark.read.parquet(f"{data}/documents.parquet").select("text").collect():
        same(both, row["text"])


def test_table(spark):
    rows = [(1, None, 0), (1, None, 0), (None, "hi <|endoftext|>", 0), (3, "", 0), (4, "long word " * 40_000, 0)]
    table = spark.createDataFrame(rows, "doc_id long, text string, ids int")
    got = [(r["doc_id"], len(r["ids"]) // 4, r["decoded"]) for r in bpe.encode_documents(table, PATH).collect()]
    assert sorted(got, key=str)[:4] == sorted([(1, 0, ""), (1, 0, ""), (3, 0, ""), (4, 80_001, "long word " * 40_000)], key=str)
    assert (None, 3, "hi <|endoftext|>") in got
    assert bpe.encode_documents(table.limit(0), PATH).count() == 0
