import random
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from docquery.llm import packing, wordids
from docquery.llm.queries import vocabulary

PATH = vocabulary("word_bpe_49k.json")


def filled(counts):
    """Sequences of a plan as sorted `(offset, length)`, and the number of pieces placed."""
    plan = packing.plan_sequences(counts)
    sequences = defaultdict(list)
    for length, rows in plan.items():
        for rank in range(counts[length]):
            first, each, sequence, offset = rows[np.searchsorted(rows[:, 0], rank, "right") - 1]
            done = rank - first
            sequences[sequence + done // each].append((offset + done % each * length, length))
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= packing.SEQUENCE
    return sequences


@pytest.mark.parametrize("seed", range(6))
def test_plans_are_whole_and_tight(seed):
    rng = np.random.default_rng(seed)
    counts = np.zeros(packing.SEQUENCE + 1, np.int64)
    for length in rng.integers(1, 1 + 400 * (seed + 1) if seed < 5 else 2049, 3000):
        counts[min(length, packing.SEQUENCE)] += 1
    sequences = filled(counts)
    least = -(-int((counts * np.arange(len(counts))).sum()) // packing.SEQUENCE)
    least = max(least, int(counts[packing.SEQUENCE // 2 + 1 :].sum()))
    assert sum(map(len, sequences.values())) == counts.sum()
    assert len(sequences) <= 1.03 * least + 1


def test_two_pieces_replace_the_smallest():
    counts = np.zeros(packing.SEQUENCE + 1, np.int64)
    for length in (1500, 400, 300, 248):
        counts[length] += 1
    # Largest first takes 1500 + 400 and leaves 148; 300 + 248 fill the room of the 400 exactly.
    sizes = sorted(sum(n for _, n in s) for s in filled(counts).values())
    assert sizes == [400, 2048]


def test_nothing_to_plan():
    assert packing.plan_sequences(np.zeros(packing.SEQUENCE + 1, np.int64)) == {}


def test_ids_equal_library(spark, data):
    from tokenizers import Tokenizer

    texts = [r["text"] for r in spark.read.parquet(f"{data}/documents.parquet").select("text").collect()]
    rng = random.Random(4)
    some = list(" \n\t\x1c\x85　'sÀßàİσΣ.,!1²é漢😀́_-") + ["<|endoftext|>", "<|startoftext|>", "The", "é"]
    texts += ["".join(rng.choice(some) for _ in range(rng.randint(0, 20))) for _ in range(1500)]
    encoder, reference = wordids.WordIds(PATH), Tokenizer.from_file(PATH)
    for at in range(0, len(texts), 100):
        part = texts[at : at + 100]
        ids, bounds = encoder.encode(pa.array(part))
        for text, a, b, want in zip(part, bounds, bounds[1:], reference.encode_batch(part, add_special_tokens=False)):
            assert ids[a:b].tolist() == want.ids, text


def test_pieces_hold_the_ids_of_the_library(spark, data):
    """Pieces put together again are the library's ids and the closing id, and ranks count each length."""
    from tokenizers import Tokenizer

    docs = spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text").repartition(3)
    pieces = packing.token_pieces(docs, PATH).orderBy("doc_id", "piece").collect()
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    found, ranks = defaultdict(bytes), defaultdict(list)
    for r in pieces:
        assert r["start"] == len(found[r["doc_id"]]) // 4 == r["piece"] * packing.SEQUENCE
        assert len(r["ids"]) == 4 * r["length"]
        found[r["doc_id"]] += r["ids"]
        ranks[r["task"], r["length"]].append(r["rank"])
    reference = Tokenizer.from_file(PATH)
    for key, text in texts.items():
        want = reference.encode(text or "", add_special_tokens=False).ids + [0]
        assert np.frombuffer(found[key], "<u4").tolist() == want
    assert all(sorted(x) == list(range(len(x))) for x in ranks.values())


def test_table(spark):
    rows = [(1, None), (2, ""), (3, "word " * 5000), (3, "word " * 5000), (None, "a b c")]
    table = spark.createDataFrame([(*r, 9) for r in rows], "doc_id long, text string, rank int").repartition(3)
    pieces = packing.token_pieces(table, PATH)
    got = packing.pack_pieces(pieces).collect()
    assert len(got) == 9
    for doc, starts in ((1, [0]), (2, [0]), (None, [0]), (3, [0, 0, 2048, 2048, 4096, 4096])):
        assert sorted(r["start"] for r in got if r["doc_id"] == doc) == starts
    assert all(len(r["ids"]) == 4 * r["length"] for r in got)
    places = defaultdict(list)
    for r in got:
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    for pieces in places.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= packing.SEQUENCE
    empty = packing.token_pieces(table.limit(0), PATH)
    assert packing.pack_pieces(empty).count() == 0
