from __future__ import annotations

import hashlib
import random

import brute
import numpy as np
import pyarrow as pa
import pytest
from cases import SCHEMA, documents, plain, with_clashes
from pyspark.sql import functions as F

from emporia.llm import exact_dedup, line_dedup, simhash

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return documents(spark, FOLDER).cache()


@pytest.fixture(scope="module")
def pairs(docs):
    return [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]


def test_perfect_hash_is_minimal_and_tells_strangers_apart():
    keys = np.frombuffer(b"".join(hashlib.sha256(str(i).encode()).digest() for i in range(5000)), np.uint8).reshape(-1, 32)
    sizes, bits, slots = exact_dedup.build_hash(keys)
    assert sorted(slots.tolist()) == list(range(5000))
    kept = keys[np.argsort(slots)]
    assert (exact_dedup.find_slots(sizes, bits, kept, keys) == slots).all()
    others = np.frombuffer(b"".join(hashlib.sha256(str(-i - 1).encode()).digest() for i in range(5000)), np.uint8).reshape(-1, 32)
    assert (exact_dedup.find_slots(sizes, bits, kept, others) == -1).all()


def test_perfect_hash_of_digests_that_share_their_first_half():
    keys = np.zeros((40, 32), np.uint8)
    keys[:, 31] = np.arange(40)
    sizes, bits, slots = exact_dedup.build_hash(keys)
    assert sorted(slots.tolist()) == list(range(40))
    assert (exact_dedup.find_slots(sizes, bits, keys[np.argsort(slots)], keys) == slots).all()


@pytest.mark.parametrize("share", [0.0, 0.5, 1.0])
def test_exact_dedup(docs, pairs, share):
    found = exact_dedup.exact_dedup(docs, share).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")
    assert plain(found.collect()) == plain(brute.exact(pairs))


def test_exact_dedup_with_clashing_columns(docs, pairs):
    found = exact_dedup.exact_dedup(with_clashes(docs)).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")
    assert plain(found.collect()) == plain(brute.exact(pairs))


def test_line_dedup(docs, pairs):
    for min_docs, min_chars in ((2, 1), (10, 1), (3, 5)):
        found = line_dedup.line_dedup(with_clashes(docs), min_docs, min_chars)
        got = found.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256)).collect()
        assert plain(got) == plain(brute.lines(pairs, min_docs, min_chars)), (min_docs, min_chars)


def test_common_line_over_many_tasks(spark):
    rng = random.Random(3)
    rows = [(i, "\n".join(rng.sample(["common", " Common ", f"own {i}", "half" if i % 2 else "", f"few {i % 700}"], 5))) for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    found = line_dedup.line_dedup(docs, 5).select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256)).collect()
    assert plain(found) == plain(brute.lines(rows, 5))


def _streamed(rows, threshold, sizes):
    """Kinds and rows that the tasks report, each given its sorted rows in batches."""
    schema = pa.schema([("h1", pa.int64()), ("h2", pa.int64()), ("doc_id", pa.int64()), ("version", pa.int64()), ("position", pa.int32())])
    out, at = [], 0
    for size in sizes:
        part = pa.Table.from_pylist(rows[at : at + size], schema=schema)
        at += size
        for batch in line_dedup._stream(threshold)(iter(part.to_batches(max_chunksize=7))):
            out += batch.to_pylist()
    return out


@pytest.mark.parametrize("held", [5, 50_000])
def test_runs_over_borders_and_of_few_documents(monkeypatch, held):
    monkeypatch.setattr(line_dedup, "HELD_ROWS", held)
    rng = random.Random(held)
    for turn in range(60):
        rows = []
        for h in range(rng.randint(1, 12)):
            for _ in range(rng.choice([1, 2, 30])):
                doc = rng.choice([None, *range(rng.choice([1, 4, 9]))])
                rows.append({"h1": h // 2, "h2": h % 2, "doc_id": doc, "version": rng.randrange(3), "position": rng.randrange(99)})
        rows.sort(key=lambda r: (r["h1"], r["h2"], r["doc_id"] is not None, r["doc_id"], r["version"], r["position"]) if r["doc_id"] is not None else (r["h1"], r["h2"], False, 0, r["version"], r["position"]))
        cuts = sorted(rng.randrange(len(rows) + 1) for _ in range(3))
        sizes = np.diff([0, *cuts, len(rows)]).tolist()
        found = _streamed(rows, 3, sizes)
        docs = {}
        for r in rows:
            docs.setdefault((r["h1"], r["h2"]), set()).add(r["doc_id"])
        common = {k for k, v in docs.items() if len(v) >= 3}
        few = {}
        for r in found:
            if r["kind"] == line_dedup.DOCUMENT:
                few.setdefault((r["h1"], r["h2"]), set()).add(r["doc_id"])
        late = {k for k, v in few.items() if len(v) >= 3} | {(r["h1"], r["h2"]) for r in found if r["kind"] == line_dedup.COMMON}
        names = ("h1", "h2", "doc_id", "version", "position")
        dropped = {tuple(r[n] for n in names) for r in found if r["kind"] == line_dedup.DROP}
        dropped |= {tuple(r[n] for n in names) for r in rows if (r["h1"], r["h2"]) in late}
        assert late <= common
        assert dropped == {tuple(r[n] for n in names) for r in rows if (r["h1"], r["h2"]) in common}


def test_a_hot_line_without_ids_takes_constant_memory():
    import tracemalloc

    n, batches = 10_000, 1000  # ten million rows of one line in documents without an id

    def rows():
        for i in range(batches):
            columns = [pa.array(np.zeros(n, np.int64)), pa.array(np.zeros(n, np.int64)), pa.nulls(n, pa.int64()),
                       pa.array(np.full(n, i)), pa.array(np.arange(n, dtype=np.int32))]
            yield pa.RecordBatch.from_arrays(columns, names=["h1", "h2", "doc_id", "version", "position"])

    tracemalloc.start()
    out = [r for b in line_dedup._stream(10)(rows()) for r in b.to_pylist()]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert [(r["kind"], r["doc_id"]) for r in out] == [(line_dedup.DOCUMENT, None)] and peak < 50e6


def test_line_dedup_may_keep_the_first_place(spark):
    rows = [(i, f"shared\nown {i}\nSHARED") for i in range(40)]
    found = line_dedup.line_dedup(spark.createDataFrame(rows, "doc_id long, text string"), 2, keep_first=True)
    got = {r.doc_id: r.kept_text for r in found.collect()}
    assert got == {i: f"shared\nown {i}" if i == 0 else f"own {i}" for i in range(40)}


def test_bitmaps_round_trip():
    import pandas as pd

    for dropped in ([0], [7], [8], [0, 3, 900], list(range(16))):
        bits = line_dedup.read_bitmap(line_dedup._bitmap(pd.Series([dropped]))[0])
        assert np.nonzero(~bits)[0].tolist() == dropped and len(bits) == max(dropped) + 1


@pytest.mark.parametrize("chunk", [1, 3, 40, 1 << 16])
def test_fingerprints_of_texts_in_pieces(monkeypatch, chunk):
    monkeypatch.setattr(simhash, "_CHUNK", chunk)
    rng = random.Random(chunk)
    texts = [None, "", " ", "a", "A b", "a b c", "  a  b\tc\nd ", "x" * 200]
    texts += ["".join(rng.choice("aB \n") for _ in range(rng.randint(0, 60))) for _ in range(200)]
    for words in (1, 2, 3, 5):
        want = [x for _, x, _ in brute.simhash(list(enumerate(texts)), words, -1)]
        assert [f"{simhash.fingerprint(t, words) % 2**64:016x}" for t in texts] == want


def test_simhash(docs, pairs):
    found = simhash.simhash_groups(with_clashes(docs)).select("doc_id", simhash.hex_print(F.col("fp")), "component_id")
    assert plain(found.collect()) == plain(brute.simhash(pairs))


def _roots(prints, distance):
    root = {p: p for p in prints}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    for i, a in enumerate(prints):
        for b in prints[i + 1 :]:
            if ((a ^ b) & (2**64 - 1)).bit_count() <= distance:
                root[find(a)] = find(b)
    groups = {}
    for p in prints:
        groups.setdefault(find(p), []).append(p)
    return sorted(sorted(g) for g in groups.values())


@pytest.mark.parametrize("distance", [1, 2, 3])
def test_links_in_crowded_and_plain_blocks(spark, monkeypatch, distance):
    monkeypatch.setattr(simhash, "PAIRED", 4)
    rng = random.Random(distance)
    prints = set()
    for _ in range(12):
        centre = rng.getrandbits(64) - 2**63
        for _ in range(rng.choice([1, 3, 40])):
            flipped = centre
            for _ in range(rng.randint(0, 4)):
                b = rng.randrange(64)
                flipped ^= 1 << b if b < 63 else -(1 << 63)
            prints.add(flipped)
    prints = sorted(prints)
    frame = spark.createDataFrame([(i, p) for i, p in enumerate(prints)], "doc_id long, fp long")
    found: dict[int, list[int]] = {}
    for row in simhash.classes(frame, distance).collect():
        found.setdefault(row.root, []).append(row.fp)
    assert sorted(sorted(g) for g in found.values()) == _roots(prints, distance)


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(300)] + [(1000, 1001)], "a long, b long")
    found = {r.node: r.root for r in simhash.components(edges).collect()}
    assert found == {**{i: 0 for i in range(1, 301)}, 1001: 1000}


def test_one_representative_of_each_group(docs, pairs):
    found = simhash.representatives(docs).collect()
    groups = {c for _, _, c in brute.simhash(pairs)}
    assert sorted(r.doc_id for r in found if r.doc_id is not None) == sorted(g for g in groups if g is not None)


def test_empty_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert exact_dedup.exact_dedup(empty).count() == 0
    assert line_dedup.line_dedup(empty).count() == 0
    assert simhash.simhash_groups(empty).count() == 0
