"""The registered queries and the pipeline at the smallest scale factor."""

import random
import re
import struct
import zlib
from collections import Counter

import duckdb
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from tallyhouse.llm import language, mixing, neardup, packing, quality
from tallyhouse.llm.queries import QUERIES, read, vocabulary
from tallyhouse.llm.sql import SQL

SF = "/root/testdata/sf0.001"
TABLES = "documents embeddings pages benchmark labels conversations".split()


def normal(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(repr(tuple(r[i] for i in order)) for r in rows)


def test_all_are_registered():
    assert sorted({q.split("_")[0] for q in QUERIES}) == sorted(f"op{n}" for n in range(1, 14))
    assert {*QUERIES, "pipeline"} <= set(entry.queries()) and set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    df = QUERIES[name](spark, SF)
    mine = df.collect()
    table = {"op3": "pages", "op11": "pages"}.get(name.split("_")[0], "embeddings" if "embedding" in name or name.split("_")[0] in ("op12", "op13") else "documents")
    assert len(mine) >= read(spark, SF, table).count()
    if name in SQL:
        con = duckdb.connect()
        for t in TABLES:
            con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
        cur = con.execute(SQL[name])
        names = [d[0] for d in cur.description]
        assert sorted(names) == sorted(df.columns)
        assert normal(mine, df.columns) == normal(cur.fetchall(), names)


def test_stages_take_effect(spark):
    """Each stage against its operator's own verdicts on the same input."""
    docs = read(spark, SF, "documents")
    steps = dict(corpus_pipeline.STAGES)
    known = steps["language_id"](spark, docs, SF)
    told = {r.doc_id for r in language.identify(docs).collect() if r.lang_pred != "und" and r.score >= 0.4}
    assert {r.doc_id for r in known.collect()} == told and known.columns == docs.columns
    good = steps["quality_rules"](spark, docs, SF)
    assert {r.doc_id for r in good.collect()} == {r.doc_id for r in quality.quality_rules(docs, read(spark, SF, "labels")).collect() if r.kept}
    one = steps["minhash_near_dedup"](spark, docs, SF)
    assert {r.doc_id for r in one.collect()} == {r.doc_id for r in neardup.classes(docs).collect() if r.kept}
    mixed = steps["mixing"](spark, docs, SF)
    copies = {r.doc_id: r.copies for r in mixing.mix(docs).collect() if r.copies}
    assert {d: n for d, n in mixed.groupBy("doc_id").count().collect()} == copies
    assert good.columns == one.columns == mixed.columns == docs.columns
    packed = steps["best_fit_packing"](spark, docs, SF)
    assert packed.groupBy("sequence_id").sum("length").agg({"sum(length)": "max"}).first()[0] <= 1024
    assert packed.columns == packing.pack(docs, vocabulary()).columns


def test_run(spark):
    out = corpus_pipeline.run(spark, SF)
    assert out.count() > 0 and [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "quality_rules", "minhash_near_dedup", "mixing", "best_fit_packing"]


def test_run_by_hand(spark, prose, tmp_path):
    """The whole chain against hand-made stages: words counted, all pairs compared, the mix by its SQL, ids by the library."""
    rng = random.Random(3)
    docs, texts = [], {}
    for i in range(90):
        lang = "en" if i % 3 else "xx"
        words = prose(i, 60 + i % 50) if lang == "en" else " ".join(rng.choice("östrük rärk ungöt möl äpö".split()) + rng.choice(["", "a", "ö"]) + str(k % 3) for k in range(70 + i % 40))
        docs.append((i, words, lang, ["a", "b", None][i % 3 - 1], len(words)))
    docs += [(100, docs[1][1], "en", "a", 0), (101, docs[1][1] + " more", "en", "b", 0), (102, None, "en", "a", 0), (103, "12 34 " * 60, "en", "a", 0), (104, "too few words", "en", "a", 0)]
    docs += [(105, "same words again " * 40, "en", "b", 0), (106, docs[4][1], "en", None, 0), (107, " ".join(prose(k, 300) for k in range(500, 508)), "en", "a", 0)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, 1, 0), (2, 0, 0)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))

    def good(text):
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        windows = Counter(zip(words, words[1:], words[2:]))
        twice = {k + j for k, w in enumerate(zip(words, words[1:], words[2:])) if windows[w] > 1 for j in range(3)}
        return len(words) >= 50 and 100 * len(twice) <= 50 * len(words)

    def bag(text):
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        return Counter(zip(*[words[k:] for k in range(5)]))

    left = [d for d in docs if d[1] and any(c.isalpha() for c in d[1]) and good(d[1])]
    kept, bags = [], [bag(d[1]) for d in left]
    for k, d in enumerate(left):  # in order of id; a link to an earlier one is a link to its class
        if not any(5 * (bags[k] & bags[j]).total() >= 4 * (bags[k] | bags[j]).total() for j in range(k)):
            kept.append(d)
    assert {d[0] for d in left} - {d[0] for d in kept} == {100, 101, 106} and {d[0] for d in docs} - {d[0] for d in left} == {102, 103, 104, 105}
    con = duckdb.connect()
    con.execute("create table documents (doc_id bigint, text varchar, lang varchar, source varchar, n_chars bigint)")
    con.executemany("insert into documents values (?, ?, ?, ?, ?)", [list(d) for d in kept])
    cur = con.execute(SQL["op10_mixing"])
    names = [c[0] for c in cur.description]
    copies = {r[names.index("doc_id")]: r[names.index("copies")] for r in cur.fetchall()}
    library, expected = Tokenizer.from_file(vocabulary()), Counter()
    for d in kept:
        ids = [*library.encode(d[1], add_special_tokens=False).ids, 2]
        first = len(ids) % 1024 or 1024
        for k, start in enumerate([0, *range(first, len(ids), 1024)]):
            piece = ids[start : first if not k else start + 1024]
            expected[(d[0], k, start, len(piece), zlib.crc32(struct.pack(f"<{len(piece)}I", *piece)))] += copies[d[0]]
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == +expected and any(r.piece for r in got)
    places = sorted((r.sequence_id, r.offset, r.length) for r in got)
    assert all(b[1] == (a[1] + a[2] if a[0] == b[0] else 0) for a, b in zip(places, places[1:])) and all(o + n <= 1024 for _, o, n in places)


def test_run_without_documents(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
