"""The corpus pipeline, stage by stage, against brute force on the whole small table."""

import collections
import random

import duckdb
from pyspark.sql import functions as F

import corpus_pipeline
from edgegraph.llm.oracles import oracle_sql
from tests.conftest import SF_SMALL
from tests.llm.test_operators import WORD, brute_components, edits

MIN_WORDS, LONGEST_RUN = 50, 60


def brute_dedup(texts):
    """Cut later copies of runs with at least 50 words; the shortest such runs have at most 50 lines, which cover the rest."""
    seqs = {d: [(i, s) for i, x in enumerate((t or "").split("\n")) if (s := x.strip(" \t\n\x0b\x0c\r"))] for d, t in texts.items()}
    first, runs = {}, collections.defaultdict(list)
    for d in sorted(seqs):
        words = [len(WORD.findall(x)) for _, x in seqs[d]]
        for a in range(len(seqs[d])):
            n = 0
            for b in range(a, min(len(seqs[d]), a + LONGEST_RUN)):
                n += words[b]
                if n >= MIN_WORDS:
                    key = tuple(x for _, x in seqs[d][a:b + 1])
                    first.setdefault(key, (d, a))
                    runs[d].append((a, b, key))
    out = {}
    for d, t in texts.items():
        gone = {i for a, b, key in runs[d] if first[key] < (d, a) for i in range(a, b + 1)}
        if gone and len(gone) == len(seqs[d]):
            continue
        lines = {seqs[d][i][0] for i in gone}
        out[d] = t if not lines else "\n".join(x for i, x in enumerate(t.split("\n")) if i not in lines)
    return out


def brute_leaks(text, items):
    import re
    norm = lambda t: re.findall(r"[a-z0-9\u0080-\U0010ffff]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
    words = norm(text)
    pairs = set(zip(words, words[1:]))
    for item in items:
        x = norm(item)
        most = len(x) // 5
        if len(x) < 5 or len(set(zip(x, x[1:])) & pairs) < len(set(zip(x, x[1:]))) - 2 * most:
            continue
        if any(min(edits(x, words[p:p + len(x) + most])) <= most for p in range(len(words))):
            return True
    return False


def test_stages_match_brute_force(spark, tmpdir_path):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    columns = docs.columns
    con = duckdb.connect()
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality_rules", "line_dedup", "minhash_neardup", "decontamination", "mixing"]
    items = [r["text"] for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    rows = {r["doc_id"]: r["text"] for r in docs.collect()}
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        path = f"{tmpdir_path}/{i}"
        stage(spark, docs, SF_SMALL).write.parquet(path)
        before = f"'{tmpdir_path}/{i - 1}/*.parquet'" if i else f"'{SF_SMALL}/documents.parquet'"
        con.execute(f"CREATE OR REPLACE VIEW documents AS SELECT * FROM read_parquet({before})")
        docs = spark.read.parquet(path)
        got = [(r["doc_id"], r["text"]) for r in docs.collect()]
        if name != "mixing":
            assert docs.columns == columns and len(got) == len(dict(got))
        if name == "quality_rules":
            kept = {r[0] for r in con.execute(f"SELECT doc_id FROM ({oracle_sql()['op3_quality_rules']}) WHERE kept").fetchall()}
            rows = {d: t for d, t in rows.items() if d in kept}
        elif name == "line_dedup":
            rows = brute_dedup(rows)
            assert all(r["n_chars"] == len(r["text"]) for r in docs.collect())
        elif name == "minhash_neardup":
            parts = brute_components(rows, 80)
            rows = {d: t for d, t in rows.items() if parts[d][1] == d}
        elif name == "decontamination":
            rows = {d: t for d, t in rows.items() if not brute_leaks(t, items)}
        else:
            taken = {r[0]: r[1] for r in con.execute(f"SELECT doc_id, taken FROM ({oracle_sql()['op9_mixing']})").fetchall()}
            size = {d: len(WORD.findall(t or "")) for d, t in rows.items()}
            copies = collections.Counter(d for d, _ in got)
            assert {d: copies[d] * size[d] for d in rows} == taken
            assert all(t == rows[d] for d, t in got) and set(docs.columns) == {*columns, "mix_shard", "mix_order"}
            assert len(got) > len(rows) / 2
            break
        assert dict(got) == rows, name
        assert 0 < len(rows)


def test_run_gives_the_last_stage(spark):
    out = corpus_pipeline.run(spark, SF_SMALL)
    assert corpus_pipeline.ORACLE_SQL is None and out.count() > 50 and "mix_shard" in out.columns


def tables(folder, docs, items):
    docs.write.parquet(f"{folder}/documents.parquet")
    items.write.parquet(f"{folder}/benchmark.parquet")
    return folder


def test_run_on_messy_and_empty_tables(spark, tmpdir_path):
    """Nulls in every column, empty and long texts, repeated rows, equal ids, clashing extra columns; then tables without rows."""
    # sentences of words that occur in all documents, in an order of their own, so that no rule takes them for junk
    def prose(n, seed):
        rng = random.Random(seed)
        return "\n".join(" ".join(rng.choice(VOCABULARY) for _ in range(12)).capitalize() + "." for _ in range(n))
    rows = [(i, prose(12, i), "en", "a" if i % 3 else "b", 1) for i in range(30)]
    rows += [(100, None, "en", "a", None), (None, prose(12, 500), None, None, None), (None, None, None, None, None), (101, "", "en", "a", 0),
             (102, prose(2000, 600), "en", "b", 1), rows[0], rows[0], (1, prose(12, 700), "en", "a", 1)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    for c in ("_row", "rep", "mix_shard", "mix_order", "kept", "h", "size", "component"):
        docs = docs.withColumn(c, F.lit(f"extra {c}"))
    items = spark.createDataFrame([(1, rows[3][1].replace("\n", " ")), (2, None), (3, ""), (4, "two words")], "item_id bigint, text string")
    folder = tables(f"{tmpdir_path}/messy", docs, items)
    kept = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:4]:  # the mix takes by target, not all
        stage(spark, kept, folder).write.parquet(f"{tmpdir_path}/{name}")
        kept = spark.read.parquet(f"{tmpdir_path}/{name}")
        assert kept.columns == docs.columns
    kept = kept.select("doc_id", "text").collect()
    texts = [r["text"] for r in kept]
    assert len(texts) == len(set(texts)) and set(texts) == {r[1] for r in rows} - {rows[3][1], None, ""}
    assert {r["doc_id"] for r in kept} == set(range(30)) - {3} | {None, 102}
    mixed = corpus_pipeline.run(spark, folder).select("text").collect()
    assert mixed and {r["text"] for r in mixed} <= set(texts)
    out = corpus_pipeline.run(spark, tables(f"{tmpdir_path}/empty", docs.limit(0), items.limit(0)))
    assert out.count() == 0 and {"doc_id", "text", "source"} <= set(out.columns)


VOCABULARY = [a + b for a in ("ba", "do", "fi", "gu", "ke", "lo", "mi", "na", "pe", "ro", "su", "ta", "ve", "wi", "zo", "ya")
              for b in ("r", "lin", "nto", "med", "s", "rak", "vel", "tion", "sh", "nder", "p", "cko", "m", "gle", "x", "th")]
