"""The pipeline's near-duplicate stage against brute-force Jaccard similarities of five-word shingles."""

import random
from collections import defaultdict
from pathlib import Path
from urllib.parse import urlparse

import pytest

import corpus_pipeline
from kalends.llm import simhash
from tests.llm.cases import documents


def shingles(text):
    words = text.lower().split()
    return frozenset(tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))) if words else frozenset()


def planted():
    """Bases of 300 words, copies with their tail replaced for similarities of 0.78 to 0.85, and short texts."""
    rng, rows = random.Random(11), []
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(6))
    for k in range(150):
        base = [word() for _ in range(300)]
        cut = round(296 * (1 - (0.78 + 0.07 * k / 149)) / (1 + 0.78 + 0.07 * k / 149))
        rows += [(2 * k, " ".join(base)), (2 * k + 1, " ".join(base[: 300 - cut] + [word() for _ in range(cut)]))]
    for k in range(150):
        base = [word() for _ in range(8 + k % 3)]
        rows += [(1000 + 2 * k, " ".join(base)), (1001 + 2 * k, " ".join([*base, word()]))]
    return rows


def brute(rows):
    """The smallest id of each class of links of 0.8 or more."""
    sets, label, holders = {d: shingles(t) for d, t in rows}, {d: d for d, _ in rows}, defaultdict(list)

    def find(d):
        while label[d] != d:
            d = label[d]
        return d

    for d, s in sets.items():
        for x in s or [None]:
            for e in holders[x]:
                both = len(s & sets[e])
                if not s or 5 * both >= 4 * (len(s) + len(sets[e]) - both):
                    a, b = find(d), find(e)
                    label[max(a, b)] = min(a, b)
            holders[x].append(d)
    return {d: find(d) for d in sets}


def table(spark, rows):
    return documents(spark, [(d, t, "en", "s") for d, t in rows]).repartition(3)


@pytest.mark.parametrize("most", [4096, 3])
def test_stage_equals_brute_force(spark, most):
    rows = planted()
    rows += [(5000, rows[0][1].upper()), (5001, ""), (5002, " ")]
    # one group of different near copies, each with one word of its own, and looser ones that share its beginning only
    base = [f"w{k}" for k in range(200)]
    rows += [(6000 + k, " ".join([*base, f"own{k}"])) for k in range(12)] + [(6100 + k, " ".join(base[:120] + [f"x{k}y{j}" for j in range(80)])) for k in range(6)]
    want = brute(rows)
    got = simhash.near_duplicates(table(spark, rows), shingle=5, radius=26, sketch=4, wide=3, limit=76, least=0.8, most=most).collect()
    assert {r.doc_id: r.component_id for r in got} == want
    if most == 4096:
        kept = corpus_pipeline.near_duplicates(spark, table(spark, rows), "").collect()
        assert sorted(r.doc_id for r in kept) == sorted(set(want.values()))


def test_texts_of_one_filler_stay_apart(spark):
    rng = random.Random(5)
    rows = [(k, " ".join(["x"] * 200 + [f"w{rng.randrange(10**9)}" for _ in range(60)])) for k in range(6)]
    rows.append((9, rows[2][1].replace(" ", "\n")))
    kept = corpus_pipeline.near_duplicates(spark, table(spark, rows), "").collect()
    assert sorted(r.doc_id for r in kept) == [0, 1, 2, 3, 4, 5]


def test_crowded_shards_equal_brute_force(spark):
    """One shared passage, a large class of near copies, texts just beside it and texts of other sizes in the same shards."""
    rng = random.Random(7)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(6))
    line = [f"notice{k}" for k in range(12)]
    copied = [word() for _ in range(60)]
    rows = [(k, " ".join([*line, *copied, f"own{k}"])) for k in range(0, 80, 2)]
    rows += [(k, " ".join([*line, *copied[: 60 - k // 4], *(word() for _ in range(k // 4))])) for k in range(1, 80, 2)]
    rows += [(100 + k, " ".join([*line, *(word() for _ in range(2 + 7 * k % 90))])) for k in range(60)]
    pairs = [[*line, *(word() for _ in range(30))] for _ in range(10)]
    rows += [(200 + 2 * k, " ".join(p)) for k, p in enumerate(pairs)] + [(201 + 2 * k, " ".join([*p, "end"])) for k, p in enumerate(pairs)]
    rows += [(300 + k, t) for k, (_, t) in enumerate(rows[:5])]
    want = brute(rows)
    got = simhash.near_duplicates(table(spark, rows), shingle=5, radius=26, sketch=4, wide=3, limit=76, least=0.8, most=16).collect()
    assert {r.doc_id: r.component_id for r in got} == want
    assert len(set(want.values())) < len(rows) - 60


def test_texts_that_stay_are_neither_stored_nor_shuffled(spark):
    rng = random.Random(3)
    rows = [(k, " ".join(f"w{rng.randrange(10**9)}" for _ in range(4000))) for k in range(200)]
    size = sum(len(t) for _, t in rows)
    docs = table(spark, rows).localCheckpoint()
    folder = Path(urlparse(spark.sparkContext.getCheckpointDir()).path)
    moved = lambda: sum(s.shuffleWriteBytes() for s in map(stages().apply, range(stages().size())))
    stages = lambda: spark.sparkContext._jsc.sc().statusStore().stageList(None, False, False, spark.sparkContext._gateway.new_array(spark.sparkContext._jvm.double, 0), None)
    held = lambda: sum(p.stat().st_size for p in folder.rglob("*.parquet"))
    before = held(), moved()
    assert corpus_pipeline.near_duplicates(spark, docs, "").count() == len(rows)
    assert held() - before[0] < size / 4
    assert moved() - before[1] < size / 4
