"""Archives, vector codes and centroids against brute force and exact round trips."""

import base64
import gzip
import hashlib
import io
import math
import os
import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import datasource as ds, functions as F

from tallyhouse.llm import clusters, codes, sql, warc, whole

PAGES = "page_id long, url string, html string, record_id string, first long, share int, payload string"
VECTORS = "vec_id long, embedding array<double>, label int, values string, near string, entry int, s int, code string"


def b32(payload):
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


@pytest.fixture(scope="module")
def pages(spark):
    def make(rows):
        return spark.createDataFrame([(*r, "x", 1, 2, "y") for r in rows], PAGES)

    return make


def by_hand(rows):
    """What archive() returns, by one dictionary."""
    firsts = {}
    for i, _, h in rows:
        if i is not None:
            firsts[h or ""] = min(firsts.get(h or "", i), i)
    out = []
    for i, _, h in rows:
        data, first = (h or "").encode(), firsts.get(h or "")
        again = first is not None and i != first
        out.append((i, len(data), b32(data), "revisit" if again else "response", first if again else None))
    return sorted(out, key=repr)


ODD = [
    (3, "http://a/3", "<p>same</p>"), (1, "http://a/1", "<p>same</p>"), (2, None, "<p>same</p>"), (4, "http://a/4", None), (5, "http://a/5", ""),
    (6, "http://a/ü?q=\r\nWARC-Type: fake", "é 漢 🙂 \r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\n"), (7, " ", "x" * 3_000_000), (None, "n", "alone"), (None, "n", "<p>same</p>"),
    (8, "http://a/8", "twice"), (8, "http://a/8", "twice"), (9, "http://a/9", "\r\n\r\n"), (9, "http://a/9", "other"), (-10, "", "last\n"),
]


@pytest.mark.parametrize("compression", ["none", "gzip"])
def test_archive_round_trip(pages, compression, tmp_path):
    path = str(tmp_path / "a")
    df = pages(ODD).repartition(3)
    found = warc.archive(df, path, compression=compression)
    assert sorted(map(tuple, found.collect()), key=repr) == by_hand(ODD)
    assert all(n.endswith(".warc.gz" if compression == "gzip" else ".warc") for n in os.listdir(path))
    whole_ = warc.read(df.sparkSession, path, payload="bytes").where("record_type = 'response'").select("payload").collect()
    assert {bytes(r[0]).decode() for r in whole_} == {h or "" for _, _, h in ODD}


def test_archive_of_many_copies_and_threshold(pages, spark):
    rows = [(i, f"u{i}", "hot" if i % 3 else f"page {i}") for i in range(400)]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert sorted(map(tuple, warc.archive(pages(rows)).collect()), key=repr) == by_hand(rows)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    short = warc.archive(pages(rows), least_bytes=4).where("record_type = 'revisit'").count()
    assert short == 0


def test_archive_of_nothing(pages):
    assert warc.archive(pages([])).count() == 0


def test_predicates_reach_the_source(pages, tmp_path):
    spark, path = pages([]).sparkSession, str(tmp_path / "b")
    rows = pages(ODD).selectExpr("concat('urn:x:', coalesce(page_id, 0)) as record_id", "'resource' as record_type", "url as target_uri", "html as payload", "cast(page_id as string) as `X-Page`")
    warc.write(rows.withColumn("payload", F.encode(F.coalesce("payload", F.lit("")), "UTF-8")), path)
    df = warc.read(spark, path, headers="X-Page")
    picked = df.where("record_type = 'resource' and `X-Page` in ('1', '2') and target_uri is not null")
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    assert " Filter " not in plan(picked) and " Filter " in plan(df.where("payload_bytes = 11"))
    assert [(r.record_id, r.payload, r.payload_bytes) for r in picked.collect()] == [("urn:x:1", None, 11)]
    assert df.where("`X-Page` is null").count() == df.where("record_type = 'warcinfo'").count() + 2
    assert df.where("not target_uri like 'http%'").count() == sum(u is not None and not u.startswith("http") for _, u, _ in ODD)
    assert df.where("content_length > 2999999").count() == 1
    assert df.where("payload_bytes = 11 and record_type <> 'warcinfo'").count() == 3 + 1


def test_predicates_follow_sql_logic():
    row = {"a": "x", "b": None}
    a, b = ("a",), ("b",)
    assert warc.holds(ds.In(a, ("y", None)), row) is None and warc.holds(ds.In(a, ("x", None)), row) is True
    assert warc.holds(ds.Not(ds.EqualTo(b, "x")), row) is None and warc.holds(ds.Not(ds.EqualTo(a, "y")), row) is True
    assert warc.holds(ds.EqualNullSafe(b, None), row) and warc.holds(ds.LessThan(a, "y"), row) and warc.holds(ds.StringContains(b, "x"), row) is None
    assert not warc.supported(ds.EqualTo(("payload",), b""), list(warc.FIELDS)) and not warc.supported(ds.EqualTo(("a", "b"), 1), ["a"])


class Counting(io.BytesIO):
    """Counts the bytes that are read."""

    n = 0

    def read(self, *a):
        out = super().read(*a)
        self.n += len(out)
        return out


def test_unwanted_payloads_are_passed_over():
    data = warc.encoded({"record_id": "u", "record_type": "response", "payload": b"z" * 1_000_000}, [])
    stream = Counting(data + data)
    for _ in range(2):
        row = warc.values(warc.header(stream, "f"), [])
        assert warc.payload_of(stream, row, False, "f") == (1_000_000, None)
    assert warc.header(stream, "f") is None and stream.n < 5000


@pytest.mark.parametrize("data", [b"WARC/1.1\r\nWARC-Type: x\r\nContent-Length: 9\r\n\r\nabc", b"no archive", b"WARC/1.1\r\nContent-Length: x\r\n\r\n", b"WARC/1.1\r\nWARC-Type"])
def test_broken_archives_fail_by_name(spark, tmp_path, data):
    (tmp_path / "broken.warc").write_bytes(data)
    with pytest.raises(Exception, match="broken.warc"):
        warc.read(spark, str(tmp_path), payload="bytes").collect()


def test_foreign_archives(spark, tmp_path):
    """Folded and repeated fields, bare line feeds, other record types, several members of one file."""
    one = b"WARC/1.0\r\nwarc-type: metadata\r\nWARC-Record-ID: <urn:m>\r\nX-Note: a\r\n  b\r\nX-Note: c\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    two = b"WARC/1.0\nWARC-Type: request\nWARC-Record-ID: <urn:r>\nContent-Type: application/http\nContent-Length: 18\n\nGET / HTTP/1.1\r\n\r\n\n\n"
    (tmp_path / "x.warc.gz").write_bytes(gzip.compress(one) + gzip.compress(two))
    (tmp_path / "y.warc").write_bytes(one + two)
    (tmp_path / "z.txt").write_bytes(b"no archive")
    rows = warc.read(spark, f"file://{tmp_path}", payload="bytes", headers="X-Note").orderBy("record_id").collect()
    assert [(r.record_id, r.record_type, r["X-Note"], bytes(r.payload)) for r in rows] == [("urn:m", "metadata", "a b", b"abc")] * 2 + [("urn:r", "request", None, b"GET / HTTP/1.1\r\n\r\n")] * 2


def test_files_roll_and_partitions_fill(pages, spark, tmp_path):
    path = str(tmp_path / "c")
    rows = [(i, f"u{i}", f"page {i} " + "x" * 5000) for i in range(40)]
    warc.write(warc.records_of(pages(rows).coalesce(1)), path, roll=20_000)
    assert len(os.listdir(path)) > 5 and all(os.path.getsize(f"{path}/{f}") < 30_000 for f in os.listdir(path))
    df = warc.read(spark, path, together=45_000)
    assert 3 < df.rdd.getNumPartitions() < len(os.listdir(path)) and df.where("record_type = 'response'").count() == 40


# Vector codes and centroids.


@pytest.fixture(scope="module")
def vectors(spark):
    def make(rows):
        return spark.createDataFrame([(*r, "x", "y", 1, 2, "z") for r in rows], VECTORS)

    return make


def some(n, size, seed=5, few=False):
    rng = random.Random(seed)
    draw = (lambda: rng.choice([-0.01, 0.0, 0.004, 0.02])) if few else (lambda: rng.gauss(0, 0.3))
    return [(i * 7 % 1009, [draw() for _ in range(size)], rng.choice([None, 1, 2])) for i in range(n)]


NAN, INF = float("nan"), float("inf")


def codes_by_hand(rows, parts, entries, rounds, scale):
    kept = [(i, v, l) for i, v, l in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    bound = lambda x: max(-whole.LIMIT, min(whole.LIMIT, x))
    ints = [(i, [math.floor(bound(x * scale)) for x in v], l) for i, v, l in kept]
    width = max((-(-len(v) // parts) * parts for _, v, _ in ints), default=0)
    place = width // parts
    ints = [(i, v + [0] * (width - len(v)), l) for i, v, l in ints]
    first = sorted(ints, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:entries]
    books = [[f[1][p * place : p * place + place] for f in first] for p in range(parts)]
    cut = [[v[p * place : p * place + place] for p in range(parts)] for _, v, _ in ints]

    def near():
        return [[min((sum((a - b) ** 2 for a, b in zip(c[p], e)), k) for k, e in enumerate(books[p])) for p in range(parts)] for c in cut]

    for _ in range(rounds):
        got = near()
        for p in range(parts):
            for k in range(len(books[p])):
                own = [c[p] for c, g in zip(cut, got) if g[p][1] == k]
                if own:
                    books[p][k] = [sum(x) // len(own) for x in zip(*own)]
    got = near()
    sha = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    errors = [sum(g[p][0] for p in range(parts)) for g in got]
    labels = {}
    for (_, _, l), e in zip(ints, errors):
        labels[l] = labels.get(l, 0) + e
    return sorted(((i, "".join(f"{g[p][1]:02x}" for p in range(parts)), e, labels[l], sha) for (i, _, l), g, e in zip(ints, got, errors)), key=repr)


EXTREME = [(5000, [1e300] * 8, 1), (5001, [-1e300, 1e-300] * 4, None)]


@pytest.mark.parametrize("rows", [
    some(120, 8), some(150, 8, few=True) + some(20, 8, few=True), some(3, 8) + EXTREME,
    some(40, 8) + some(40, 8) + [(None, [0.5] * 8, 1), (1, None, 1), (2, [], None), (3, [NAN] * 8, 1), (4, [INF] * 8, 1), (5, [None] * 8, 1), (6, [0.1] * 7, 2), (7, [0.1] * 11, 2)],
    [(1, [], 1), (None, [], None)],
])
def test_codes_as_by_hand(vectors, rows):
    found = codes.compress(vectors(rows).repartition(3), entries=16, rounds=2, pivots=3)
    assert sorted(map(tuple, found.collect()), key=repr) == codes_by_hand(rows, 4, 16, 2, 1024)


def test_codes_of_nothing(vectors):
    assert codes.compress(vectors([])).count() == 0 and codes.compress(vectors([(1, None, 1)])).columns == codes.compress(vectors(some(2, 8))).columns


def test_bounds_prune_and_lose_nothing():
    rng = np.random.default_rng(3)
    centres = rng.integers(-400, 400, (40, 16))
    rows = centres[rng.integers(0, 40, 3000)] + rng.integers(-20, 20, (3000, 16))
    entries = centres[rng.integers(0, 40, 256)] + rng.integers(-20, 20, (256, 16))
    entries[200:210] = entries[:10]  # ties
    pivots = codes.spread(entries, 8)
    root = lambda a, b: np.sqrt(codes.squared(a, b).astype(float))
    code, best, evaluated = codes.nearest(rows, root(rows, pivots), entries, root(entries, pivots))
    exact = codes.squared(rows, entries)
    assert (code == exact.argmin(1)).all() and (best == exact.min(1)).all()
    assert evaluated < 0.15 * exact.size


def clusters_by_hand(rows, size, centroids, rounds, scale, seed):
    bound = lambda x: max(-whole.LIMIT, min(whole.LIMIT, x))
    ints = [(i, [math.floor(bound(x * scale)) for x in v]) for i, v, _ in rows if v is not None and len(v) == size and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted(ints, key=lambda r: (hashlib.sha256(f"{seed}:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    centres = [list(v) for _, v in order[:centroids]]

    def near():
        return [min((sum((a - b) ** 2 for a, b in zip(v, c)), k) for k, c in enumerate(centres)) for _, v in ints]

    for _ in range(rounds):
        got = near()
        for k in range(len(centres)):
            own = [v for (_, v), g in zip(ints, got) if g[1] == k]
            if own:
                centres[k] = [sum(x) // len(own) for x in zip(*own)]
    got = near()
    total = [sum(d for d, c in got if c == k) for k in range(len(centres))]
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    return sorted(((i, c, d, total[c], sum(total), sha[c]) for (i, _), (d, c) in zip(ints, got)), key=repr)


@pytest.mark.parametrize("rows", [
    some(200, 8), some(150, 8, few=True) + some(30, 8, few=True), some(4, 8) + EXTREME,
    some(60, 8) + [(None, [0.5] * 8, 1), (None, [0.25] * 8, 1), (1, None, 1), (2, [], None), (3, [NAN] * 8, 1), (4, [-INF] * 8, 1), (5, [None] * 8, 1), (6, [0.1] * 7, 2)],
])
def test_clusters_as_by_hand(vectors, rows):
    found = clusters.cluster(vectors(rows).repartition(3), size=8, centroids=12, rounds=3)
    assert sorted(map(tuple, found.collect()), key=repr) == clusters_by_hand(rows, 8, 12, 3, 256, 2)


def test_clusters_of_nothing(vectors):
    assert clusters.cluster(vectors([])).count() == 0
    assert clusters.cluster(vectors(some(5, 8))).count() == 0  # none has 64 components


def test_tables_give_exact_distances():
    rng = np.random.default_rng(1)
    values, centroids = rng.integers(-whole.LIMIT, whole.LIMIT, (50, 64)), rng.integers(-300, 300, (7, 64))
    assert (clusters.distances(values, centroids) == codes.squared(values, centroids)).all()


def test_sql_twins_of_odd_pages(pages, tmp_path):
    rows = [r for r in ODD if r[0] != 6]  # the twin has no other difference, but SQL files must hold plain text
    con = duckdb.connect()
    con.execute("create table pages (page_id bigint, url varchar, html varchar)")
    con.executemany("insert into pages values (?, ?, ?)", [list(r) for r in rows])
    cur = con.execute(sql.WARC)
    names = [d[0] for d in cur.description]
    order = [names.index(c) for c in ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")]
    assert sorted((tuple(r[k] for k in order) for r in cur.fetchall()), key=repr) == by_hand(rows)
