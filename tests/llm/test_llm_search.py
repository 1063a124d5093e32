"""Line deduplication, lexical search, whitening; queries against their SQL on small fixtures."""

import hashlib
import math
import random
import re

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from netrollup.llm import lexical_search, line_dedup, whitening
from netrollup.llm.queries import ORACLE, QUERIES


def against_sql(spark, folder, name, **tables):
    """A query and its SQL on the same rows; both sorted."""
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for table, rows in tables.items():
        pq.write_table(rows, f"{folder}/{table}.parquet")
        con.execute(f"create view {table} as select * from '{folder}/{table}.parquet'")
    df = QUERIES[name](spark, str(folder))
    want = con.execute(ORACLE[name])
    names = [d[0] for d in want.description]
    assert sorted(df.columns) == sorted(names)
    got = sorted(map(str, (tuple(r[c] for c in names) for r in df.collect())))
    assert got == sorted(map(str, want.fetchall()))
    return df


def documents(texts):
    return pa.table({"doc_id": pa.array(range(len(texts)), pa.int64()),
                     "text": pa.array(texts, pa.string())})


def personal_texts():
    """Recurring mail domains, networks, card issuers and number prefixes, each with terms that
    stand with them alone or mostly; copies; addresses without a companion."""
    rng = random.Random(5)
    filler = [f"plain{i}" for i in range(40)]
    texts = []
    for i in range(300):
        words = rng.sample(filler, 8)
        kind = i % 10
        if kind == 0:
            words += ["Florbex", f"person{i}@plant.example"]
        elif kind == 1:
            words += ["gronkle", f"10.20.030.{i % 250}", "yard" if i % 3 else "plain0"]
        elif kind == 2:
            words += ["wimzat", f"+1 (202) 555-{1000 + i}"]
        elif kind == 3:
            words += ["issuer", "4111 1111 1111 1111" if i % 20 else "4111-1111-1111-1111"]
        elif kind == 4:
            words += [f"user{i}@lone{i}.example"]
        elif kind == 5 and i < 30:
            words += ["Florbex", "yard"]
        rng.shuffle(words)
        texts.append(" ".join(words))
    return [*texts, *texts[:60], None, "", "Florbex alone, and gronkle"]


def test_personal_data_against_sql_where_terms_disclose(spark, tmp_path):
    df = against_sql(spark, tmp_path, "op1_pii", documents=documents(personal_texts()))
    spans = [r.spans for r in df.collect()]
    assert sum("removed:" in s for s in spans) > 30
    assert sum("generalised:" in s for s in spans) > 5


# --- lines -----------------------------------------------------------------------------------

LONG = "Subscribe to our weekly letter and never miss a story, {}"
SPACE = " \t\n\x0b\x0c\r"


def line_texts(seed, n=120):
    """Lines that many documents share, in upper case and with white space at their ends."""
    rng = random.Random(seed)
    shared = [LONG.format(w) for w in ("reader", "Ünder allem", "friend  ", "日本" * 20)]
    shared += ["short line", "x" * 39, "y" * 40, " " + "z" * 40]
    texts = []
    for i in range(n):
        lines = [rng.choice(["", " ", "own line that nobody else has, number " + "9" * 10 + str(i)])]
        for _ in range(rng.randint(0, 4)):
            line = rng.choice(shared[: 2 + i % 7])
            line = line.upper() if rng.random() < 0.2 and line.isascii() else line
            lines.append(rng.choice(["", " ", "\t\r"]) + line + rng.choice(["", " \x0b"]))
        texts.append("\n".join(lines))
    return [*texts, None, "", "\n", LONG.format("reader") + "\n" + LONG.format("reader")]


def key(line):
    return re.sub("[A-Z]", lambda m: m.group().lower(), line.strip(SPACE))


def plain_drop(rows, min_docs=5):
    """rows of (id, text) -> set of (id, n_lines, n_dropped, kept)."""
    holders = {}
    for i, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= 40:
                holders.setdefault(key(line), set()).add(i)
    rank = lambda i: (i is not None, i or 0)
    last = {k: max(ids, key=rank) for k, ids in holders.items() if len(ids) >= min_docs}
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if key(x) not in last or last[key(x)] == i]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(map(str, out))


@pytest.mark.parametrize(("batches", "fan"), [(1, 3), (4, 3), (5, 2)])
def test_lines_against_plain_python(docs_of, batches, fan):
    rows = list(enumerate(line_texts(batches)))
    rows += [(3, rows[3][1]), (4, "another text of one id\n" + LONG.format("reader")),
             (None, LONG.format("reader")), (None, LONG.format("reader") + "\nmore")]
    out = line_dedup.drop_lines(docs_of(rows, clashing=True), batches=batches, fan=fan).collect()
    got = sorted(str((r.doc.doc_id, r.n_lines, r.n_dropped, r.kept)) for r in out)
    assert got == plain_drop(rows)


def test_lines_against_sql(spark, tmp_path):
    df = against_sql(spark, tmp_path, "op12_line_dedup", documents=documents(line_texts(9)))
    assert sum(r.n_dropped for r in df.collect()) > 50


def test_runs_hold_every_hash_once(spark):
    """Levels are compacted, and no run repeats what another holds."""
    runs = line_dedup.LineRuns(spark, buckets=3, fan=2)
    rng = random.Random(1)
    count = {}
    for batch in range(5):
        rows = [(rng.randint(0, 30), 0, batch * 100 + rng.randint(0, 20)) for _ in range(60)]
        for h, _, i in set(rows):
            count.setdefault(h, set()).add(i)
        runs.add(spark.createDataFrame(rows, "h1 long, h2 long, id long"))
        held = [r.h1 for name in runs.runs for r in spark.table(name).collect()]
        assert sorted(held) == sorted(count)
        assert all(len(level) < 2 for level in runs.levels)
    got = {r.h1: r.last for r in runs.frequent(7).collect()}
    assert got == {h: max(ids) for h, ids in count.items() if len(ids) >= 7} and got
    names = runs.runs
    runs.release()
    assert not any(spark.catalog.tableExists(name) for name in names)


def test_line_edges(docs_of):
    assert line_dedup.drop_lines(docs_of([])).count() == 0
    rows = [(i, "q" * 100_000 + f"\n{i}") for i in range(6)] + [(9, None)]
    out = {r.doc_id: r for r in line_dedup.deduplicated(docs_of(rows, clashing=True)).collect()}
    assert out[9].text is None and out[0].text == "0" and out[5].text == rows[5][1]
    assert line_dedup.deduplicated(docs_of(rows)).columns == docs_of(rows).columns


# --- ranked search ---------------------------------------------------------------------------

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def plain_terms(text):
    return [re.sub("[A-Z]", lambda m: m.group().lower(), t) for t in re.findall(TERM, text or "")]


def plain_search(items, docs, top=50):
    terms = [plain_terms(t) for _, t in docs]
    n_docs, n_terms = sum(map(bool, terms)), sum(map(len, terms))
    df = {}
    for ts in terms:
        for t in set(ts):
            df[t] = df.get(t, 0) + 1
    held = {}
    for item, text in items:
        held.setdefault(item, set()).update(plain_terms(text))
    out = []
    for item, wanted in held.items():
        scores = []
        for (i, _), ts in zip(docs, terms, strict=True):
            m = 50 + (50 * len(ts) * n_docs) // max(n_terms, 1)
            score = 0
            for t in wanted:
                if tf := ts.count(t):
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    score += w * ((10**9 * tf) // (1000 * tf + 20 * m))
            if score > 0:
                scores.append((-score, i is None, i or 0, i))
        out += [(item, rank, s[3], -s[0]) for rank, s in enumerate(sorted(scores)[:top], 1)]
    return sorted(map(str, out))


def search_rows(seed):
    rng = random.Random(seed)
    words = ["the", "The", "tHEm", "he", "a", "über", "Über", "x1", "1x", "日本", "é", "b", "zeta"]
    glue = [" ", "  ", "-", ".", "\n", "'", "/", "@", "[", "`", "{", "\x7f", "\x1c"]
    docs = []
    for i in range(160):
        n = rng.choice([0, 1, 3, 8, 30])
        docs.append((i, "".join(rng.choice(words) + rng.choice(glue) for _ in range(n))))
    docs += [(500, None), (501, ""), (502, "- -"), (503, "the them the he"),
             (504, "zeta " * 20000)]
    items = [(1, "The über"), (2, "he, HE; x1 zeta"), (3, None), (4, "unseen"), (5, "é the 日本 a b")]
    return items, docs


@pytest.mark.parametrize(("top", "block"), [(50, 1 << 20), (3, 64)])
def test_search_against_plain_python(spark, docs_of, top, block):
    items, docs = search_rows(top)
    docs += [(7, docs[7][1]), (None, "the über zeta")]
    items += [(2, "more é"), (None, "a the")]
    query = spark.createDataFrame(items, "item_id long, text string")
    got = lexical_search.search(query, docs_of(docs, clashing=True).repartition(3), top=top,
                                block_bytes=block)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(str(tuple(r)) for r in got.collect()) == plain_search(items, docs, top)


def test_search_against_sql(spark, tmp_path):
    items, docs = search_rows(2)
    against_sql(spark, tmp_path, "op13_lexical_search",
                documents=pa.table({"doc_id": [i for i, _ in docs], "text": [t for _, t in docs]}),
                benchmark=pa.table({"item_id": [i for i, _ in items],
                                    "text": [t for _, t in items]}))


def test_search_without_rows(spark, docs_of):
    items = spark.createDataFrame([(1, "the")], "item_id long, text string")
    assert lexical_search.search(items, docs_of([])).count() == 0
    assert lexical_search.search(items.limit(0), docs_of([(1, "the")])).count() == 0
    # In every document, a term still has a weight above zero.
    assert lexical_search.search(items, docs_of([(1, "the")])).first().score > 0


def test_large_scores_add_up_exactly(monkeypatch, spark, docs_of):
    items, docs = search_rows(4)
    monkeypatch.setattr(lexical_search, "_EXACT", 0)
    query = spark.createDataFrame(items, "item_id long, text string")
    got = lexical_search.search(query, docs_of(docs))
    assert sorted(str(tuple(r)) for r in got.collect()) == plain_search(items, docs)


# --- whitening -------------------------------------------------------------------------------

def vectors(seed, n=300, dim=24):
    rng = np.random.default_rng(seed)
    made = rng.standard_normal((n, dim)) * np.linspace(2, 0.2, dim)
    return [[float(v) for v in row] for row in made.astype(np.float32)]


def plain_whitening(rows, k=16):
    x = np.array([[math.floor(64 * c) + 1_000_000 for c in v] for v in rows], object)
    fit = np.array(sorted({tuple(v) for v in x}), object)
    n, sums = len(fit), fit.sum(0)
    centred = ((n * fit - sums) / n).astype(float)
    cov = centred.T @ centred / n
    e, q = np.linalg.eigh(cov)
    e, q = e[::-1][:k], q[:, ::-1][:, :k]
    gap = n * x - sums
    return n, (gap ** 2).sum(1), (gap / n).astype(float) @ (q / np.sqrt(e)), e / np.trace(cov)


@pytest.mark.parametrize("seed", [1, 2])
def test_whitening_against_numpy(spark, seed):
    good = vectors(seed)
    good += good[:5]
    bad = [None, [], [1.0], [None] + good[0][1:], [float("nan")] + good[0][1:],
           [float("-inf")] + good[0][1:]]
    rows = [(i, v, "x", 0) for i, v in enumerate(good + bad)]
    df = spark.createDataFrame(
        rows, "vec_id long, embedding array<float>, doc string, component int").repartition(3)
    out = whitening.whiten(df).collect()
    n, deviation, want, explained = plain_whitening(good)
    assert {r.doc.vec_id for r in out} == set(range(len(good)))
    assert len(out) == 16 * len(good) and {r.n for r in out} == {n}
    got = np.zeros((len(good), 16))
    for r in out:
        got[r.doc.vec_id, r.component - 1] = r.whitened
        assert r.deviation == deviation[r.doc.vec_id]
        assert r.explained == pytest.approx(explained[r.component - 1], rel=1e-12)
        assert r.identity_error < 1e-10
    sign = np.sign((got * want).sum(0))
    assert np.abs(got * sign - want).max() < 1e-9


def test_whitening_of_few_dimensions_and_edges(spark):
    def of(rows):
        return whitening.whiten(spark.createDataFrame(
            [(i, v) for i, v in enumerate(rows)], "vec_id long, embedding array<double>"))

    assert of([]).count() == 0 and of([None]).count() == 0
    assert of([[1.0, 2.0]] * 3).count() == 0                        # no variance
    line = of([[float(i), 2.0 * i, 0.0] for i in range(10)]).collect()
    assert {r.component for r in line} == {1} and len(line) == 10    # one direction
    huge = of([[1e300, 0.0], [0.0, 1.0], [3.0, 4.0]]).collect()
    assert {r.doc.vec_id for r in huge} == {0, 1, 2}


def test_deviations_stay_exact_beyond_64_bits():
    x = np.array([[2 ** 40, 3], [5, 2 ** 41]], np.int64)
    sums = np.array([2 ** 60 + 1, 7], object)
    gap = whitening._deviations(x, 2 ** 30, sums)
    assert gap.tolist() == [[2 ** 70 - 2 ** 60 - 1, 3 * 2 ** 30 - 7],
                            [5 * 2 ** 30 - 2 ** 60 - 1, 2 ** 71 - 7]]


@pytest.mark.parametrize("spectrum", [
    np.exp(-np.arange(120) / 10), 1 + np.arange(120) / 120, np.r_[np.full(5, 3.0), np.ones(115)],
    np.r_[np.ones(4), np.zeros(116)]])
def test_jacobi_davidson_reaches_double_precision(spectrum):
    rng = np.random.default_rng(3)
    turn = np.linalg.qr(rng.standard_normal((len(spectrum),) * 2))[0]
    matrix = (turn * spectrum) @ turn.T
    widths = []

    def product(block):
        widths.append(block.shape[1])
        return matrix @ block

    values, vectors_ = whitening.leading_pairs(product, len(spectrum), 16)
    assert np.allclose(values, np.sort(spectrum)[::-1][:16], rtol=0, atol=1e-13 * spectrum.max())
    assert np.abs(matrix @ vectors_ - vectors_ * values).max() < 1e-13 * spectrum.max()
    assert np.abs(vectors_.T @ vectors_ - np.eye(16)).max() < 1e-13
    assert max(widths) <= 20                      # the matrix is never asked for as a whole


def test_minres_solves_indefinite_systems():
    rng = np.random.default_rng(0)
    a = rng.standard_normal((30, 30))
    a = a + a.T
    shift = np.array([0.3, -1.0, 2.0])
    rhs = rng.standard_normal((30, 3))
    x = whitening.minres(lambda z: a @ z - shift * z, rhs, 200, 1e-12)
    assert np.abs(a @ x - shift * x - rhs).max() < 1e-8


def test_hashes_of_kept_text(spark, tmp_path):
    pq.write_table(documents(["a\nb"]), f"{tmp_path}/documents.parquet")
    row = QUERIES["op12_line_dedup"](spark, str(tmp_path)).first()
    assert row.kept_sha256 == hashlib.sha256(b"a\nb").hexdigest()
