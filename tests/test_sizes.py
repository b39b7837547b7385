"""Tasks of wide steps hold about ``session.TASK_ROWS`` rows, whatever the input's size, and give the same rows."""

import contextlib
import gzip
import hashlib
import io
import random
from collections import Counter, defaultdict
from pathlib import Path

import pytest

import __spark_entry__ as entry_module
from kalends import session
from kalends.operators import sets
from kalends.sources import ingest

SF_DIR = "/root/testdata/sf0.001"


def plan_of(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain()
    return out.getvalue()


@pytest.mark.skipif(not Path(SF_DIR).exists(), reason="driver tables are absent")
@pytest.mark.parametrize("name,keys", (("bridge_components", 1), ("release_lag", 2), ("sample_difference", 1), ("select_best_price", 2), ("rejected_candidates", 2)))
def test_wide_steps_are_dealt_by_rows(spark, monkeypatch, name, keys):
    queries = entry_module.queries()
    before = Counter(queries[name](spark, SF_DIR).collect())
    monkeypatch.setattr(session, "TASK_ROWS", 100)
    df = queries[name](spark, SF_DIR)
    rows = spark.read.parquet(f"{SF_DIR}/lineitem.parquet").count()
    plan = plan_of(df)
    assert plan.count("REPARTITION_BY_NUM") >= keys
    assert f", {-(-rows // 100)})" in plan or f", {-(-3 * rows // 100)})" in plan
    assert Counter(df.collect()) == before


def test_bridge_of_many_components_equals_brute_force(spark):
    rng = random.Random(5)
    bridge = [(f"c{k:03d}", "wide") for k in range(130)] + [("d", "one"), ("e", "two"), ("f", "two")]  # wide takes more than two numbers
    rows = [("whole", c, 1.0) for c, _ in bridge] + [("twice", c, 1.0) for c, _ in bridge] + [("twice", "c128", 1.0)]
    rows += [("part", c, 2.0) for c, _ in bridge if c not in ("c063", "c064", "c129", "f")] + [(f"r{rng.randrange(6)}", rng.choice(bridge)[0], 1.0) for _ in range(400)]
    category, required = dict(bridge), defaultdict(set)
    for c, k in bridge:
        required[k].add(c)
    groups = defaultdict(Counter)
    for e, c, _ in rows:
        groups[e, category[c]][c] += 1
    want = {key: "INCOMPLETE_BRIDGE" if set(n) != required[key[1]] else "AMBIGUOUS_COMPONENT" if max(n.values()) > 1 else "" for key, n in groups.items()}
    for size in (None, len(rows)):
        found = ingest.bridge_components(spark.createDataFrame(rows, "economy string, component string, value double"), spark.createDataFrame(bridge, "component string, category string"), size).collect()
        assert {(r.economy, r.category): r.reason for r in found} == want
        assert all(r.present == "|".join(sorted(groups[r.economy, r.category])) and r.required == "|".join(sorted(required[r.category])) for r in found)
        assert {(r.economy, r.category): r.value for r in found}["whole", "wide"] == 130.0


def test_sample_difference_counts_repeated_rows_and_nulls(spark):
    rng = random.Random(7)
    make = lambda n: [(rng.choice((1, 2, 3, None)), rng.choice(("a", None))) for _ in range(n)]
    left, right = make(60), make(45)
    a, b = (spark.createDataFrame(rows, "k int, v string") for rows in (left, right))
    want = Counter((*r, "LEFT_ONLY") for r in (Counter(left) - Counter(right)).elements()) + Counter((*r, "RIGHT_ONLY") for r in (Counter(right) - Counter(left)).elements())
    for rows in (None, 105):
        df = sets.sample_difference(a, b, ["k", "v"], rows)
        assert plan_of(df).count("Exchange hashpartitioning") == 1  # one grouping for both ways
        assert Counter(tuple(r) for r in df.collect()) == want


def line_hash(data, size=1 << 16):
    sha = lambda b: hashlib.sha256(b).hexdigest().upper()
    lines = [sha(line) for line in (data[:-1] if data.endswith(b"\n") else data).split(b"\n")]
    blocks = [sha("".join(lines[k : k + size]).encode()) for k in range(0, len(lines), size)]
    return "lines:" + hashlib.sha256(f"{len(data)}:{sha(''.join(blocks).encode()).lower()}".encode()).hexdigest()


def test_large_files_are_hashed_in_byte_ranges(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(ingest, "BLOCK_LINES", 7)
    rng = random.Random(11)
    data = bytes(rng.randrange(256) for _ in range(20_000))
    files = {"a.bin": data, "b.bin": data[:9000] + bytes([data[9000] ^ 1]) + data[9001:], "c.bin": data.replace(b"\r", b"\n"), "d.bin": b"x\r\n" * 1000, "e.bin": b"x\n\r" * 1000, "f.bin": b"y" * 3000, "g.bin": b"y" * 2999 + b"\n",
             "small.bin": data[:500], "h.gz": gzip.compress(data)}
    (tmp_path / "in").mkdir()
    for name, content in files.items():
        (tmp_path / ("in" if name > "c" else ".") / name).write_bytes(content)
    (tmp_path / "other.txt").write_bytes(data)
    want = {n: hashlib.sha256(c).hexdigest() if len(c) <= 1000 or n == "h.gz" else line_hash(c, 7) for n, c in files.items()}
    kept = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for most in ("777", "128m"):  # where ranges end does not matter
            spark.conf.set("spark.sql.files.maxPartitionBytes", most)
            assert {r.name: r.actual for glob in ("*.bin", "*.gz") for r in ingest.file_hashes(spark, str(tmp_path), glob, 1000).collect()} == want
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", kept)
    assert len(set(want.values())) == len(files)
