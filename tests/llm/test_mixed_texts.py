"""Languages, divergence of sources and infilling against brute force, on awkward texts and tables."""

import hashlib
import random
import re
import unicodedata
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from kalends.llm import divergence, infill, languages, queries
from tests.llm.cases import corpus, documents, words

ROWS = corpus(4)


@pytest.fixture(scope="module")
def docs(spark):
    return documents(spark, ROWS).repartition(5).cache()


# --- infilling

AWKWARD = [
    "a\nb\nc\n", "a\nb\nc", "\n", "\n\n\n", "a", "x\r\ny\rz\n", " a\u0085b\n ", "é漢🙂\n🙂🙂\nz", "has <P> in\nit\n", "has <S>\n", "has <M>", "<\n<P\n>S>\nM>\n", "", None,
    "\n".join("é" * (k % 7) for k in range(5000)), "x" * 300_000, "\n" * 3000,
]


def cut(doc, text, seed=7, rate=100, spm=50):
    text, digest = text or "", hashlib.sha256(f"{seed}:{'null' if doc is None else doc}".encode()).hexdigest()
    h, lines = [int(digest[k : k + 8], 16) for k in (0, 8, 16, 24)], re.findall(r"[^\n]*\n|[^\n]+", text)
    low, high = sorted(x % (len(lines) + 1) for x in h[:2])
    p, m, s = "".join(lines[:low]), "".join(lines[low:high]), "".join(lines[high:])
    if not text or re.search("<[PSM]>", text) or h[2] % 100 >= rate:
        return doc, len(lines), "plain", None, None, text
    if h[3] % 100 < spm:
        return doc, len(lines), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return doc, len(lines), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@pytest.mark.parametrize("setup", [{}, {"seed": 11, "rate": 60, "spm": 10}])
def test_infill_matches_brute_force(spark, docs, setup):
    rows = [(d, t) for d, t, *_ in ROWS] + [(1000 + k, t) for k, t in enumerate(AWKWARD)] * 2 + [(2000 + k, "a\nb\nc\nd\n") for k in range(60)]
    table = documents(spark, [(d, t, "en", "s") for d, t in rows]).repartition(3)
    made = infill.transform(table, others=("n_chars",), **setup)
    got = made.withColumn("back", infill.restored(F.col("output"), F.col("form"))).collect()
    assert Counter((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in got) == Counter(cut(d, t, **setup) for d, t in rows)
    assert Counter((r.doc_id, r.back) for r in got) == Counter((d, t or "") for d, t in rows)
    assert {r.form for r in got} == {"plain", "psm", "spm"}
    assert infill.transform(table.limit(0)).count() == 0


def test_skip_list_finds_every_rank():
    rng = np.random.default_rng(3)
    for n in (0, 1, 2, 5, 64, 3000):
        widths = rng.integers(0, 9, n)
        lines = infill.SkipList(widths)
        assert [lines.chars_before(k) for k in range(n + 1)] == np.r_[0, np.cumsum(widths)].tolist()
        assert n < 3000 or 4 <= len(lines.lanes) <= 9
        for lane in lines.lanes:
            assert lane.units.sum() == n and lane.chars.sum() == widths.sum()
        with pytest.raises(IndexError):
            lines.chars_before(n + 1)


# --- divergence

def priced(rows, least, most, add=5, scale=10**9):
    """The contract, word for word, over (lang, source, text)."""
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    counts, df, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for lang, source, text in rows:
        found = re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", (text or "").translate(lower))
        groups[lang or ""].add(source or "")
        counts[lang or "", source or ""].update(found)
        df[lang or ""].update(set(found))
    out = Counter()
    for lang, sources in groups.items():
        kept = [t for t, n in df[lang].items() if n >= least]
        every = Counter({t: sum(counts[lang, s][t] for s in sources) for t in kept})
        price = lambda c: {t: 1 + scale * (c[t] + add) // (sum(c[x] for x in kept) + add * len(kept)) for t in kept}  # noqa: E731, B023
        own, q = {s: price(counts[lang, s]) for s in sources}, price(every)
        for s in sources:
            pairs = sorted(((o, sum(abs(own[s][t] - own[o][t]) for t in kept)) for o in sources - {s}), key=lambda x: (-x[1], x[0].encode()))
            terms = sorted(((t, own[s][t] - q[t]) for t in kept if counts[lang, s][t] and own[s][t] > q[t]), key=lambda x: (-x[1], x[0].encode()))
            for part, found in (("pair", pairs), ("term", terms[:most])):
                out.update((lang, s, part, item, value, k + 1) for k, (item, value) in enumerate(found))
    return out


def grouped(seed, groups=23):
    rng = random.Random(seed)
    rows = []
    for k in range(300):
        lang, source = ("x", "y", "z", None)[k % 4 if k % 3 else 0], f"s{rng.randrange(groups)}" if k % 5 else "hot"
        text = " ".join(words(rng, rng.randrange(0, 60), 90)).title() + rng.choice(["", " Éa-b_c ÉA", "\x00nul\x7f漢字 9z9", " a A"])
        rows.append((lang, source, text))
    rows += [("x", None, None), ("x", "", ""), ("only numbers", "a", "1 2 3"), ("only numbers", "b", None), ("alone", "a", "word"), (None, None, None), ("x", "hot", "long " + "tail " * 3000)]
    return rows + rows[:40]


@pytest.mark.parametrize("tile", [{}, {"rows": 4, "columns": 16}])
def test_divergence_matches_brute_force(spark, tile):
    rows = grouped(5)
    table = documents(spark, [(k, text, lang, source) for k, (lang, source, text) in enumerate(rows)]).repartition(4)
    got = divergence.divergence(table, least=4, most=7, **tile)
    assert Counter(map(tuple, got.collect())) == priced(rows, 4, 7)
    assert divergence.divergence(table, least=10_000, **tile).where("part = 'term' or value <> 0").count() == 0
    assert divergence.divergence(table.limit(0), **tile).count() == 0


def test_divergence_agrees_with_sql_on_awkward_texts(spark, tmp_path):
    rows = [(k, text, lang, source) for k, (lang, source, text) in enumerate(grouped(6, 5) * 6)]
    documents(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    got = Counter(map(tuple, queries.op12_source_divergence(spark, str(tmp_path)).collect()))
    assert got == Counter(con.execute(queries.ORACLES["op12_source_divergence"]).fetchall()) and len(got) > 300


def test_counts_are_passed_on_in_parts(spark, monkeypatch):
    rows = grouped(7)
    table = documents(spark, [(k, text, lang, source) for k, (lang, source, text) in enumerate(rows)])
    want = Counter(map(tuple, divergence.term_counts(table).collect()))
    batches = [b.select(["lang", "source", "text"]) for b in table.select(*(F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "source", "text"))).toArrow().to_batches()]
    monkeypatch.setattr(divergence, "HELD", 50)
    monkeypatch.setattr(divergence, "PART", 7)
    got = defaultdict(lambda: [0, 0])
    parts = list(divergence._count(batches))
    for batch in parts:
        for r in batch.to_pylist():
            cell = got[r["lang"], r["source"], r["term"]]
            cell[0], cell[1] = cell[0] + r["n"], cell[1] + r["df"]
    assert Counter((*k, *v) for k, v in got.items()) == want and len(parts) > 40


def test_joint_descent_equals_dense_matrix():
    rng = np.random.default_rng(9)
    for a, b, columns, density in ((1, 1, 1, 1.0), (5, 40, 100, 0.02), (33, 7, 70, 0.4), (20, 20, 300, 0.0), (17, 3, 16, 1.0)):
        dense, trees = [], []
        for rows in (a, b):
            zero = rng.integers(1, 50, rows)
            cells = np.where(rng.random((rows, columns)) < density, rng.integers(1, 1000, (rows, columns)), zero[:, None])
            row, column = np.nonzero(cells != zero[:, None])
            height = max(int(max(columns, 40) - 1).bit_length() - divergence.LEAF, 0)
            dense.append(cells)
            trees.append(divergence.QuadTree(row, column, cells[row, column], zero, height))
        assert (divergence.distances(*trees, columns) == np.abs(dense[0][:, None] - dense[1][None]).sum(axis=2)).all()


# --- languages

def grams(text):
    """Trigrams of the lower-cased runs of letters and marks, a space around each."""
    kept = "".join(c if unicodedata.category(c)[0] in "LM" else " " for c in text.lower())
    return Counter(f" {w} "[k : k + 3] for w in kept.split() for k in range(len(w)))


def bucket(gram, buckets):
    total = 0
    for c in gram:
        total = (total * int(languages.ODD) + ord(c)) % 2**64
    return (((total ^ (total >> 32)) * int(languages.MIX)) % 2**64 >> 33) % buckets


@pytest.mark.parametrize("part", [1 << 20, 5, 1])
def test_trigrams_match_brute_force(monkeypatch, part):
    monkeypatch.setattr(languages, "PART", part)
    for text in [t for _, t, *_ in ROWS[:45] if t] + ["", "a", "  Ab c", "é漢字🙂x y", "हिन्दी में", "x" * 9000, "1 2\n3", "tail "]:
        want = Counter()
        for gram, n in grams(text).items():
            want[bucket(gram, 1 << 16)] += n
        place, times = languages.counted(text, 1 << 16)
        assert dict(zip(place.tolist(), times.tolist())) == want and place.tolist() == sorted(want)


LETTERS = {"aa": "abcdeou", "bb": "fghijau", "cc": "klmnpei", "dd": "qrstvoa"}


def spoken(rng, lang, n):
    return " ".join("".join(rng.choice(LETTERS[lang]) for _ in range(rng.randrange(2, 8))) for _ in range(n))


def tongues(seed=2):
    rng = random.Random(seed)
    rows = [(k, spoken(rng, lang, rng.randrange(3, 120)).title(), lang, f"src{k % 3}") for k in range(400) for lang in [list(LETTERS)[k % 4 if k % 3 else 0]]]
    odd = [None, "", "  \n", "12 + 3 = 15!", "🙂", "_", "ok", "漢字", "ꙮ", spoken(rng, "bb", 30_000), "a " * 20_000]
    rows += [(1000 + k, t, lang, None) for k, t in enumerate(odd) for lang in (("aa", None) if len(t or "") < 20 else (None, None))]
    return rows + rows[:5] + [(None, rows[0][1], "aa", "s"), (None, None, None, None)]


def test_languages_of_single_and_mixed_texts(spark):
    rows = tongues()
    table = documents(spark, rows).repartition(4)
    model = languages.fit(table)
    assert model.langs == sorted(LETTERS)
    got = languages.identify(table, model).collect()
    assert len(got) == len(rows)
    true = {d: (t, lang) for d, t, lang, _ in rows if d is not None}
    for r in got:
        assert 0 <= r.score <= 1 and len(r.langs) == len(r.shares) and r.shares == sorted(r.shares, reverse=True)
        if r.doc_id is None:
            continue
        text, lang = true[r.doc_id]
        if not any(unicodedata.category(c).startswith("L") for c in text or ""):
            assert (r.lang_pred, r.score, r.langs) == ("und", 0.0, [])
        elif r.doc_id < 1000:
            assert r.lang_pred == lang and r.langs == [lang] and abs(sum(r.shares) - 1) < 1e-6
    rng = random.Random(8)
    mixed = []
    for k, (one, two) in enumerate([("aa", "bb"), ("cc", "aa"), ("dd", "bb")] * 5):
        mixed.append((k, f"{spoken(rng, one, 80)} {spoken(rng, two, 40)}", one, two))
    three = (99, " ".join(spoken(rng, lang, n) for lang, n in (("aa", 100), ("cc", 60), ("dd", 40))), "aa", "cc")
    for r in languages.identify(documents(spark, [*mixed, three]), model).collect():
        if r.doc_id == 99:
            assert r.langs == ["aa", "cc", "dd"] and np.allclose(r.shares, [0.5, 0.3, 0.2], atol=0.05)
        else:
            _, _, one, two = mixed[r.doc_id]
            assert r.langs == [one, two] and abs(r.shares[0] - 2 / 3) < 0.05


def test_languages_learn_outside_the_held_out_fifth_only(spark):
    rows = tongues()
    held = lambda d: d is not None and zlib.crc32(str(d).encode()) % 5 == 0
    model = languages.fit(documents(spark, rows))
    other = languages.fit(documents(spark, [(d, "zz zz" if held(d) else t, "qq" if held(d) else lang, "?") for d, t, lang, _ in rows]).repartition(3))
    assert model.langs == other.langs and (model.chances == other.chances).all()
    counts = {lang: Counter() for lang in LETTERS}
    for d, text, lang, _ in rows:
        if lang is not None and text is not None and not held(d):
            for gram, n in grams(text).items():
                counts[lang][bucket(gram, 1 << 16)] += n
    every = sum(counts.values(), Counter())
    total = sum(every.values())
    for c, lang in enumerate(model.langs):
        own = sum(counts[lang].values())
        for b in [*list(every)[:300], 12345]:
            want = (counts[lang][b] + 2000 * every[b] / total) / (own + 2000) if every[b] else 1
            assert abs(model.chances[b, c] - want) < 1e-6
    found = documents(spark, rows).select("doc_id", languages.held_out(F.col("doc_id")).alias("h")).collect()
    assert all(r.h == held(r.doc_id) for r in found)


def test_mixture_shares_reach_the_maximum():
    rng = np.random.default_rng(4)
    chances = rng.dirichlet(np.full(60, 0.3), 3).T
    times = rng.multinomial(6000, chances @ [0.5, 0.3, 0.2])
    place = np.flatnonzero(times)
    setup = languages.Settings(rounds=2000, close=1e-9)
    share, likelihood = languages.mixtures([place], [times[place]], chances.astype(np.float32), setup)
    value = lambda w: (times * np.log(chances @ w)).sum()
    grid = max(value(np.array([a, b, 1 - a - b])) for a in np.linspace(0.01, 0.98, 98) for b in np.linspace(0.01, 0.98, 98) if a + b < 0.995)
    assert likelihood[0] >= grid - 1e-2 and abs(value(share[0]) - likelihood[0]) < 0.1


def test_languages_without_learnt_rows(spark):
    none = documents(spark, [])
    model = languages.fit(none)
    assert model.langs == [] and languages.identify(none, model).count() == 0
    rows = languages.identify(documents(spark, [(1, "text", None, None)]), languages.fit(documents(spark, [(1, "text", None, None)]))).collect()
    assert [(r.lang_pred, r.score, r.langs) for r in rows] == [("und", 0.0, [])]
    two = documents(spark, [(1, "aaa", "b", None), (2, "aaa", "a", None), (3, None, "c", None), (4, "!!", "d", None)])
    model = languages.fit(two)
    assert [r.lang_pred for r in languages.identify(two.where("doc_id = 1"), model).collect()] == [model.langs[0]]
    with pytest.raises(Exception, match="more than 1 languages"):
        languages.fit(two, languages.Settings(most_langs=1))
