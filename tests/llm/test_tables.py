"""Archives, chats, vectors, the pipeline and the registered queries."""

import base64
import hashlib
from collections import Counter, defaultdict
from pathlib import Path

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from kalends.llm import bktree, chat, components, neighbours, queries, simhash, warc
from tests.llm.cases import CLASHING, corpus, documents

SF_DIR = "/root/testdata/sf0.001"


def with_clashes(df):
    return df.select("*", *(F.lit(f"own {c}").alias(c) for c in CLASHING if c not in df.columns))


# --- archives

def page_rows():
    big = "".join(f"<p>{k} é WARC/1.1\r\n\r\nContent-Length: 3</p>\n" for k in range(900))
    html = ["<html>a</html>", "<html>a</html>", None, "", big, big, "\r\n\r\n", "0\r\n\r\n", "x" * 8192, "é" * 5000, "<html>a</html>"]
    rows = [(k, None if k == 7 else f"http://x.example/é {k}\r\nX: y", h) for k, h in enumerate(html)]
    return [*rows, rows[8], (None, None, "<html>a</html>"), (None, "u", "only here")]


def test_archives_round_trip(spark):
    rows = page_rows()
    folder = warc.archive_folder(spark)
    warc.write_archives(with_clashes(spark.createDataFrame(rows, "page_id long, url string, html string")), folder, segment=1000, chunk=300, most=4)
    got = warc.read_pages(spark, folder).collect()
    groups = defaultdict(list)
    for page, _, html in rows:
        groups[(html or "").encode()].append(page)
    want, payloads = Counter(), Counter()
    for payload, ids in groups.items():
        first = max((i for i in ids if i is not None), default=None)
        for i in ids:
            kind = "response" if i == first else "revisit"
            want[i, len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode(), kind, None if i == first else first] += 1
            payloads[i, payload if i == first else None] += 1
    assert Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got) == want
    assert Counter((r.page_id, None if r.payload is None else bytes(r.payload)) for r in got) == payloads
    kinds = Counter(r.type for r in warc.read_records(spark, folder).collect())
    assert kinds["continuation"] > 50 and kinds["revisit"] == sum(n for k, n in want.items() if k[3] == "revisit") > 3


def test_small_payloads_need_no_revisit(spark):
    folder = warc.archive_folder(spark)
    warc.write_archives(spark.createDataFrame([(1, "u", "aa"), (2, "u", "aa"), (3, "u", "long text"), (4, "u", "long text")], "page_id long, url string, html string"), folder, least=5)
    got = {r.page_id: (r.record_type, r.refers_to) for r in warc.read_pages(spark, folder, payloads=False).collect()}
    assert got == {1: ("response", None), 2: ("response", None), 3: ("revisit", 4), 4: ("response", None)}


def test_archives_of_no_pages(spark):
    folder = warc.archive_folder(spark)
    warc.write_archives(spark.createDataFrame([], "page_id long, url string, html string"), folder)
    assert warc.read_pages(spark, folder).count() == 0


def test_segments_come_in_any_order_and_gaps_raise(spark):
    part = [("o", k, 9 if k == 3 else None, "response" if k == 1 else "continuation", None, None, None, b"abc") for k in (3, 1, 2)]
    whole = spark.createDataFrame(part, warc.RECORDS)
    assert bytes(warc.reassemble(whole).first().block) == b"abcabcabc"
    for broken in (part[:2], [part[0], part[1], part[1], part[2]], [(*part[0][:2], 8, *part[0][3:]), *part[1:]], part[1:]):
        with pytest.raises(Exception, match="segments do not fit together"):
            warc.reassemble(spark.createDataFrame(broken, warc.RECORDS)).collect()


def test_broken_archives_raise():
    record = warc._record([("WARC-Type", "response")], b"abc")
    assert [b for _, b in warc.parse(record + record)] == [b"abc", b"abc"]
    for broken in (record[:-1], record[1:], record.replace(b"Length: 3", b"Length: 4")):
        with pytest.raises(ValueError):
            list(warc.parse(broken))
    assert warc.dechunk(b"3;x=y\r\nabc\r\nA\r\n0123456789\r\n0\r\nTrailer: 1\r\n\r\n") == b"abc0123456789"
    for broken in (b"3\r\nab\r\n0\r\n\r\n", b"3\r\nabc0\r\n\r\n", b"3\r\nabc\r\n0\r\n", b"zz"):
        with pytest.raises(ValueError):
            warc.dechunk(broken)


# --- chats

def test_chat_matches_sql(spark, tmp_path):
    text = ["hi", None, "", "a\n<|im_start|>user\n\\<|im_end|> <\\|x [INST] [\\\\/INST] <<SYS>> </s>\\", "🙂 é" * 50, "same", "same"]
    rows = [(c, t, role, text[(c + t) % 7]) for c in range(9) for t, role in enumerate(["system", "user", "assistant", "user", "assistant", None, "tool\n<x\\n>"][: c + 1])]
    rows += [(20, k, "assistant" if k % 2 else "user", f"turn {k}") for k in range(70)] + [(None, 1, "user", "x"), (None, None, "assistant", "y"), (3, 0, "system", "tie"), (3, 0, "system", "tie")]
    df = with_clashes(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    df.write.parquet(str(tmp_path / "conversations.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/conversations.parquet/*.parquet'")
    want = con.execute(queries.ORACLES["op6_chat_format"]).fetchall()
    assert Counter(map(tuple, queries.op6_chat_format(spark, str(tmp_path)).collect())) == Counter(want)


def test_reply_trees(spark):
    #       1 -> 2 -> 4, 1 -> 3 -> 5 -> 6, and a root of its own; a second tree whose parent is missing
    nodes = [("a", 1, None, "user", "q", 0.0), ("a", 2, 1, "assistant", "no", 1.0), ("a", 3, 1, "assistant", "yes", 5.0), ("a", 4, 2, "user", "why", None), ("a", 5, 3, "user", "ok", 1.0), ("a", 6, 5, "assistant", "bye", 1.0), ("a", 9, None, "user", "alone", 0.0), ("b", 1, 77, "user", "orphan", 2.0)]
    df = with_clashes(spark.createDataFrame(nodes, "conv_id string, node long, parent long, role string, text string, score double"))
    got = {(r.conv_id, r.leaf): (r.score, [t.text for t in r.turns], r.said) for r in chat.format_paths(df).select("conv_id", "leaf", "score", chat.read_turns(F.col("formatted")).alias("turns"), chat.read_loss(F.col("formatted"), F.col("loss")).alias("said")).collect()}
    assert got == {
        ("a", 4): (1.0, ["q", "no", "why"], "no"), ("a", 6): (7.0, ["q", "yes", "ok", "bye"], "yesbye"), ("a", 9): (0.0, ["alone"], ""), ("b", 1): (2.0, ["orphan"], ""),
    }
    assert {(r.conv_id, r.leaf) for r in chat.format_paths(df, branches=1).collect()} == {("a", 6), ("b", 1)}
    assert chat.format_paths(df.limit(0)).count() == 0
    with pytest.raises(ValueError, match="cycle"):
        chat.format_paths(spark.createDataFrame([("a", 1, 2, "user", "x", 0.0), ("a", 2, 1, "user", "y", 0.0)], df.select("conv_id", "node", "parent", "role", "text", "score").schema))


# --- vectors

def test_neighbours(spark):
    rng = np.random.default_rng(5)
    own = rng.normal(size=(1500, 16)).astype(np.float32) * rng.uniform(0.5, 2, (1500, 1)).astype(np.float32)
    own[200:260] = own[200]
    rows = [(k, [float(x) for x in v]) for k, v in enumerate(own)]
    rows += [rows[5], (2000, None), (2001, [0.0] * 16), (2002, [float("nan")] * 16), (2003, [float("inf")] * 16), (2004, [None] * 16), (None, rows[1][1]), (2020, [1.0] * 8), (2040, [2.0] * 8)]
    df = with_clashes(spark.createDataFrame(rows, "vec_id long, embedding array<float>"))
    got = defaultdict(list)
    for r in neighbours.nearest(df, df.where("vec_id % 20 = 0"), k=20, shard_rows=400, block_rows=30).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r["rank"], r.vec_id, r.score))
    assert got[2020] == [(1, 2040, 16.0)] and got[2040] == [(1, 2020, 16.0)] and set(got) == {*range(0, 1500, 20), 2020, 2040}
    exact, hits = own.astype(np.float64), 0
    for q in range(0, 1500, 20):
        score = exact @ exact[q]
        score[q] = -np.inf
        order = np.lexsort((np.arange(1500), -score))[:20]
        assert [x[0] for x in got[q]] == list(range(1, 21))
        assert all(abs(score[v] - s) < 1e-9 for _, v, s in got[q])
        assert [x[1] for x in got[q]] == [x[1] for x in sorted(got[q], key=lambda x: (-x[2], x[1]))]
        hits += len({x[1] for x in got[q]} & set(order.tolist()))
    assert hits / (75 * 20) > 0.97
    assert got[200][:19] == [(k + 1, 201 + k, got[200][0][2]) for k in range(19)] or got[200][0][2] > float(exact[200] @ exact[200])
    assert neighbours.nearest(df.limit(0), df.limit(0)).count() == 0


# --- helpers

def test_forest_search_equals_brute_force():
    rng = np.random.default_rng(1)
    prints = np.unique(rng.integers(0, 1 << 63, 300).astype(np.uint64) & np.uint64(0xFFFF))
    root = np.repeat([0, 100], [100, len(prints) - 100])
    tree = bktree.build(root, prints)
    for radius in (0, 2, 5):
        found = {(int(q), int(k)) for a, b in bktree.search(root, prints, tree, prints, root, radius) for q, k in zip(a, b)}
        assert found == {(i, j) for i in range(len(prints)) for j in range(len(prints)) if root[i] == root[j] and int(prints[i] ^ prints[j]).bit_count() <= radius}


def test_components_of_paths_stars_and_loops(spark):
    links = [(k, k + 1) for k in range(0, 70)] + [(500, k) for k in range(501, 560)] + [(900, 900), (None, 3), (600, 601), (601, 600), (601, 600)]
    got = dict(map(tuple, components.component_labels(spark.createDataFrame(links, "a long, b long")).collect()))
    assert got == {**{k: 0 for k in range(71)}, **{k: 500 for k in range(500, 560)}, 600: 600, 601: 600}
    assert components.component_labels(spark.createDataFrame([], "a long, b long")).count() == 0


# --- pipeline and queries

def test_pipeline_stages(spark):
    rows = corpus()
    docs = documents(spark, rows)
    kept = corpus_pipeline.near_duplicates(spark, docs, SF_DIR).collect()
    classes = Counter((r.component_id, r.fingerprint if r.component_id is None else None) for r in simhash.near_duplicates(docs, shingle=5, radius=18, sketch=4, wide=3, limit=44).collect())
    assert len(kept) == len(classes) and len({r.doc_id for r in kept}) == len(kept)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), SF_DIR).count() == 0, name
    for stage in (corpus_pipeline.near_duplicates, corpus_pipeline.private_data, corpus_pipeline.mixing, corpus_pipeline.quality_filter):
        assert tuple(stage(spark, docs, SF_DIR).columns) == corpus_pipeline.COLUMNS
    assert corpus_pipeline.private_data(spark, docs, SF_DIR).count() == corpus_pipeline.tokens(spark, docs, SF_DIR).count() == len(rows)


@pytest.mark.skipif(not Path(SF_DIR).exists(), reason="driver tables are absent")
def test_pipeline_run_equals_its_stages(spark):
    out = corpus_pipeline.run(spark, SF_DIR).collect()
    docs = queries.table(spark, SF_DIR, "documents")
    labels = {r.doc_id: r.quality for r in queries.table(spark, SF_DIR, "labels").collect()}
    filtered = corpus_pipeline.quality_filter(spark, docs, SF_DIR).cache()
    left = {r.doc_id for r in filtered.collect()}
    wrong = sum((labels[d] == 1) != (d in left) for d in labels)
    assert wrong <= 0.05 * len(labels)
    for _, stage in corpus_pipeline.STAGES[1:]:
        filtered = stage(spark, filtered, SF_DIR)
    columns = ("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
    assert Counter(tuple(r[c] for c in columns) for r in out) == Counter(map(tuple, filtered.select(*columns).collect()))


@pytest.mark.skipif(not Path(SF_DIR).exists(), reason="driver tables are absent")
@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - {"op12_source_divergence"}))  # its rows are pairs and terms; see the SQL
def test_every_query_covers_its_table(spark, name):
    rows = queries.QUERIES[name](spark, SF_DIR).count()
    source = {"op3": "pages", "op6": "conversations", "op9": "embeddings"}.get(name.split("_")[0], "documents")
    df = queries.table(spark, SF_DIR, source)
    want = {"op6": lambda: df.select("conv_id").distinct().count() + 1, "op9": lambda: 20 * df.where("vec_id % 20 = 0").count()}.get(name.split("_")[0], df.count)()
    assert rows == want


@pytest.mark.skipif(not Path(SF_DIR).exists(), reason="driver tables are absent")
@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_queries_agree_with_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "pages", "conversations"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    df, cursor = queries.QUERIES[name](spark, SF_DIR), con.execute(queries.ORACLES[name])
    assert [d[0] for d in cursor.description] == df.columns
    assert Counter(map(tuple, df.collect())) == Counter(cursor.fetchall())


def test_substring_sql_on_awkward_texts(spark, tmp_path):
    documents(spark, corpus(2)).write.parquet(str(tmp_path / "documents.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    got = queries.op4_substring_dedup(spark, str(tmp_path)).collect()
    assert Counter(map(tuple, got)) == Counter(con.execute(queries.ORACLES["op4_substring_dedup"]).fetchall())
