"""Operators on single texts against plain Python."""

import hashlib
import random
import re
from collections import Counter
from functools import cache

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from netrollup.llm import license as notices
from netrollup.llm import pii, quality, rules, token_counts
from netrollup.llm.queries import BPE, PIECES, QUERIES, RANKS

EDGES = [
    (1, None), (2, ""), (3, " \t\n"), (None, "no id"), (4, "twice"), (4, "twice"),
    (5, "word " * 3000), (6, "x" * 30000), (7, "🎉 ü\x0b日本 a b"),
]


# --- personal data ---------------------------------------------------------------------------

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def holds(kind, value):
    digits = re.sub("[^0-9]", "", value)
    return {"email": True, "ip": kind == "ip" and all(int(x) <= 255 for x in value.split(".")),
            "card": 13 <= len(digits) <= 19 and luhn(digits),
            "phone": 9 <= len(digits) <= 15}[kind]


def plain_spans(text):
    return {k: [(m.start(), m.end()) for m in re.finditer(p, text) if holds(k, m.group())]
            for k, p in PLAIN.items()}


def spark_spans(spark, docs_of, texts):
    from pyspark.sql import functions as F

    rows = docs_of(list(enumerate(texts))).select(
        "doc_id", pii.base_spans(F.coalesce("text", F.lit(""))).alias("b")).collect()
    return {r.doc_id: {k: [(m.s, m.e) for m in r.b[k]] for k in PLAIN} for r in rows}


def test_base_spans_against_plain_patterns(spark, docs_of):
    rng = random.Random(3)
    alphabet = ["a", "b.", "@", "c-", "_", "1", "25", "300", ".", "+", " ", "-", "(", ")", "é", "🎉",
                "4111 1111 1111 1111", "x@y.z", "+1 (202) 555-0143", "10.0.0.1"]
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 40))) for _ in range(1500)]
    texts += ["a@b.c_d@e.f", "1.2.3.4.5.6.7.8", "@@a@b", "0000001.2.3.4", "4111-1111-1111-1112"]
    found = spark_spans(spark, docs_of, texts)
    for i, text in enumerate(texts):
        assert found[i] == plain_spans(text), text


def test_base_spans_of_very_long_texts(spark, docs_of):
    texts = ["1" * 200_000, "a" * 200_000, "10.1.2.3 " * 3000, "a@" * 50_000, "+1" + "(" * 100_000,
             "1 " * 60_000]
    found = spark_spans(spark, docs_of, texts)
    assert len(found[2]["ip"]) == 3000 and found[2]["ip"][-1] == (9 * 2999, 9 * 2999 + 8)
    assert not any(found[i][k] for i in (0, 1, 3, 4, 5) for k in PLAIN)


def disclosure_docs():
    """A value that 'zorblat' always accompanies and 'quimby' mostly; others are common."""
    rows = [(i, f"write to zorblat quimby common at secret@mail.example today {i}") for i in range(4)]
    rows += [(10 + i, f"common words quimby without value {i} ten more") for i in range(1)]
    rows += [(20 + i, f"common words of no interest number {i}") for i in range(200)]
    return rows


def test_terms_that_give_a_value_away(docs_of):
    docs = docs_of(disclosure_docs(), clashing=True)
    out = {r.doc_id: r for r in pii.sanitise(docs).collect()}
    assert pii.sanitise(docs).columns == docs.columns
    assert out[0].text == " to  [TERM] common at [EMAIL]  0"
    assert "secret" not in out[0].text and "[EMAIL]" in out[0].text
    assert "common" in out[0].text
    # Without the value a document stays as it is, whatever words it has.
    assert all(out[r[0]].text == r[1] for r in disclosure_docs() if r[0] >= 10)
    spans = {r.doc.doc_id: {m.v: m.remove for m in r.terms} for r in pii.find(docs).collect()}
    assert spans[0]["zorblat"] is True and spans[0]["quimby"] is False
    assert not spans[20]


def test_shares_follow_the_definition(docs_of):
    from math import log2

    docs = docs_of(disclosure_docs())
    got = {(r.value, r.term): r.share for r in
           pii.disclosing_terms(docs, generalise_at=-99).collect()}
    n = len(disclosure_docs())
    assert got["email:secret@mail.example", "quimby"] == pytest.approx(
        log2(4 * n / (4 * 5)) / log2(n / 4))
    assert got["email:secret@mail.example", "zorblat"] == 1


def shared_docs():
    """Values that occur once each: a mail domain, a network and a number prefix recur.  And one
    value in five copies of one text."""
    rows = [(i, f"ask florbex here person{i}@plant.example now {i}") for i in range(4)]
    rows += [(10 + i, f"host gronkle has 10.20.30.{i} as address {i}") for i in range(4)]
    rows += [(20 + i, f"dial wimzat for +1 (202) 555-{1000 + i} any time {i}") for i in range(4)]
    rows += [(30 + i, f"dial yopnik for +44{'  -.'[i % 2:][:1]}20 7946 0958 any time {i}")
             for i in range(4)]
    rows += [(40, "once snarvol at single@alone.example only")] * 5
    rows += [(50 + i, f"ask here now has host as address dial for any time {i}") for i in range(200)]
    return rows


def test_values_that_occur_once_share_entities(docs_of):
    found = pii.find(docs_of(shared_docs())).collect()
    terms = {r.doc.doc_id: {m.v for m in r.terms} for r in found}
    assert all("florbex" in terms[i] for i in range(4))          # mail domain
    assert all("gronkle" in terms[10 + i] for i in range(4))     # network
    assert all("wimzat" in terms[20 + i] for i in range(4))      # number prefix
    assert all("yopnik" in terms[30 + i] for i in range(4))      # one number, written in two ways
    assert not terms[40]                                         # copies are one text
    assert not any(terms[50 + i] for i in range(200))


def test_counts_are_of_whole_texts(docs_of):
    """A name in the heading and the address in the footer, never near each other."""
    filler = "common words of no interest " * 8
    rows = [(i, f"Florbex {filler}{i} footer@mail.example") for i in range(10)]
    rows += [(20 + i, f"{filler} {i} footer mail example") for i in range(100)]
    terms = {r.doc.doc_id: {m.v: m.remove for m in r.terms}
             for r in pii.find(docs_of(rows)).collect()}
    assert all(terms[i] == {"Florbex": True} for i in range(10))


def test_a_text_gets_its_own_terms_only(spark):
    pairs = spark.createDataFrame([(f"k{i}", "email:hot@mail.example", f"term{i}") for i in range(5)],
                                  "key string, value string, term string")
    told = spark.createDataFrame([("email:hot@mail.example", f"term{i}", 0.9 + i % 2 / 10)
                                  for i in range(50)], "value string, term string, share double")
    maps = [r.told for r in pii._own_terms(pairs, told, 1.0).collect()]
    assert sorted(map(str, maps)) == [f"{{'term{i}': {i % 2 == 1}}}" for i in range(5)]


def plain_shares(texts, entities_of, support=3, at=0.9):
    """Shares over distinct texts, pair by pair."""
    from math import log2

    texts = sorted(set(texts))
    words = [set(w for w in re.findall(r"[^\W_]+", t.lower()) if len(w) >= 3) for t in texts]
    held = [entities_of(t) for t in texts]
    n, df = len(texts), Counter(w for ws in words for w in ws)
    df_c = Counter(c for cs in held for c in cs)
    both = Counter((c, w) for cs, ws in zip(held, words, strict=True) for c in cs for w in ws)
    out = {}
    for (c, w), k in both.items():
        if min(k, df_c[c]) >= support:
            share = 1.0 if k == df[w] else None
            if share is None and n > df_c[c]:
                share = log2(k * n / (df_c[c] * df[w])) / log2(n / df_c[c])
            if share is not None and share >= at:
                out[c, w] = share
    return out


def test_no_pair_is_lost_before_it_is_counted(docs_of):
    """Random texts with recurring mail domains, some of them copies, against all pairs."""
    rng = random.Random(11)
    vocabulary = [f"word{i}" for i in range(60)]
    texts = []
    for _ in range(220):
        domain = rng.choice(["", "", "", "a.example", "b.example", "c.example"])
        own = [f"{domain[:1] * 3}{rng.randint(0, 5)}"] if domain and rng.random() < 0.8 else []
        body = rng.sample(vocabulary, 6) + own + ([f"u{rng.randint(0, 9)}@{domain}"] if domain else [])
        texts.append(" ".join(body))
    texts += texts[:40]

    def entities_of(text):
        found = re.findall(r"(\w+@([a-c]\.example))", text)
        return {e for v, d in found for e in (f"email:{v}", f"email-domain:{d}")}

    for at in (0.9, 0.5):
        got = {(r.value, r.term): r.share for r in pii.disclosing_terms(
            docs_of(list(enumerate(texts))), generalise_at=at).collect()}
        want = plain_shares(texts, entities_of, at=at)
        assert set(got) == set(want) and len(want) > 10
        assert all(got[k] == pytest.approx(want[k]) for k in want)


def test_pii_edges(docs_of):
    docs = docs_of(EDGES, clashing=True)
    assert sorted(map(str, (r.text for r in pii.sanitise(docs).collect()))) == sorted(
        map(str, (t for _, t in EDGES)))
    assert pii.sanitise(docs_of([])).count() == 0
    text = "call +1 (202) 555-0143 or 4111 1111 1111 1111, 10.0.0.1"
    assert pii.sanitise(docs_of([(1, text)])).first().text == "call [PHONE] or [CARD], [IP]"


# --- quality rules ---------------------------------------------------------------------------

def plain_measures(text):
    found = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(found[i:i + 5]) for i in range(len(found) - 4)]
    counts = Counter(windows)
    covered = {j for i, w in enumerate(windows) if counts[w] > 1 for j in range(i, i + 5)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(found), sum(map(len, found)), len(re.findall(r"[#*$%&|<>]", text)),
            len(lines) - len(set(lines)), len(covered))


def test_rules_against_plain_python(docs_of):
    rng = random.Random(5)
    rows = list(EDGES)
    for i in range(300):
        vocabulary = ["a", "b", "é", "c#", "d|", "!!"][:rng.randint(1, 6)]
        rows.append((100 + i, "".join(rng.choice(vocabulary) + rng.choice([" ", "\n", "\x0b", "  "])
                                      for _ in range(rng.randint(0, 60)))))
    got = rules.ledger(docs_of(rows, clashing=True)).collect()
    assert len(got) == len(rows)
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    assert Counter((r.doc_id, *(r[n] for n in names)) for r in got) == Counter(
        (d, *plain_measures(t or "")) for d, t in rows)
    for r in got:
        assert bool(r.failed & 1) == (r.n_words < 10)
        assert bool(r.failed & 2) == (100 * r.n_repeat_words > 20 * r.n_words)
    assert rules.ledger(docs_of([])).count() == 0


def test_policies_and_ablations(spark):
    entries = spark.createDataFrame([(b,) for b in (0, 1, 1, 3, 2, 4, 12)], "failed long")
    assert entries.where(rules.fails("base")).count() == 4
    got = {r.rule: (r.failing, r.failing_this_alone)
           for r in rules.ablations(entries, "v1").collect()}
    assert got == {"few_words": (3, 2), "repeated_windows": (2, 1), "symbols": (2, 1),
                   "duplicate_lines": (1, 0)}


# --- license notices -------------------------------------------------------------------------

def plain_base(text):
    found = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub(
        "[A-Z]", lambda m: m.group().lower(), text))
    places = [(i, label) for phrase, label in notices.BASE.items() for i in range(len(found))
              if found[i:i + phrase.count(" ") + 1] == phrase.split()]
    return len(found), len(places), min(places, default=(None,))[0], max(places, default=(None,))[0]


TEXTS = ["CC-BY cc by CC  BY.", "GNU General Public License, all rights reserved. ALL RIGHTS RESERVED",
         "accc by", "cc\x00by", "cc by-nc general public licence", "é cc by é"]


def test_base_phrases(docs_of):
    rows = [*EDGES, *[(50 + i, t) for i, t in enumerate(TEXTS)]]
    got = notices.scan_notices(docs_of(rows, clashing=True)).collect()
    assert Counter((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word) for r in got) \
        == Counter((d, *plain_base(t or "")) for d, t in rows)
    assert notices.scan_notices(docs_of([])).count() == 0


def test_notices_with_typing_errors_and_their_spans(docs_of):
    text = "Intro. Licenced  under the\nApache Licens, Version 2.0! More words."
    row = notices.scan_notices(docs_of([(1, text)])).first()
    assert row.labels == "apache" and 0.9 < row.score < 1
    (span,) = row.spans
    assert text[span.start:span.end] == "Licenced  under the\nApache Licens, Version 2.0"
    assert span.edits == 2


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_seeds_miss_no_notice_within_its_edits():
    """Against comparing the notice with every stretch of words."""
    notice = "released under the mit license"
    search = notices.NoticeSearch([("mit", notice)])
    allowed = len(notice) // notices.EDIT_EVERY
    rng = random.Random(1)
    for _ in range(300):
        spoilt = list(notice)
        for _ in range(rng.randint(0, 5)):
            i = rng.randrange(len(spoilt))
            if spoilt[i] != " ":
                spoilt[i] = rng.choice(["", "x", spoilt[i] + "y"])
        line = "some words " + "".join(spoilt) + " and more"
        parts = line.split(" ")
        within = any(edits(" ".join(parts[i:j]), notice) <= allowed
                     for i in range(len(parts)) for j in range(i + 1, len(parts) + 1))
        assert bool(search.notices_in(line)) == within, line


@pytest.mark.parametrize("label,notice,spoilt", [
    ("reserved", "all rights reserved", "all xights reserved"),
    ("mit", "released under the mit license", "xeleased under the mit license")])
@pytest.mark.parametrize("between", [" ", " foo ", " foo bar baz "])
def test_notices_in_a_row_are_all_found(label, notice, spoilt, between):
    search = notices.NoticeSearch([(label, notice)])
    for parts in [(spoilt, notice), (notice, spoilt), (spoilt, spoilt, notice),
                  (spoilt, notice, spoilt, notice)]:
        line = between.join(parts)
        got = [(line[a:b].strip(), e) for _, a, b, e, _ in search.notices_in(line)]
        assert got == [(p, int(p == spoilt)) for p in parts], line


# --- token counts ----------------------------------------------------------------------------

@pytest.fixture(scope="module")
def unigram():
    from tokenizers import Tokenizer, models, pre_tokenizers

    vocabulary = token_counts.unigram_vocabulary(PIECES)
    reference = Tokenizer(models.Unigram(vocabulary, 0, True))
    reference.pre_tokenizer = pre_tokenizers.Metaspace(
        replacement="▁", prepend_scheme="always", split=True)
    counter = token_counts.ViterbiCounter(vocabulary)
    return counter, lambda t: len(reference.encode(t, add_special_tokens=False).ids)


@settings(max_examples=300, deadline=None)
@given(st.text(st.one_of(st.sampled_from("abcdefghij  \n▁é日🎉<0x>s"), st.characters(
    exclude_categories=["Cs"])), max_size=60))
def test_counts_equal_the_tokenizers(unigram, text):
    counter, reference = unigram
    assert counter.text(text) == reference(text)


def test_ties_follow_the_tokenizers():
    from tokenizers import Tokenizer, models

    vocabulary = [("<unk>", -9.0), ("a", -1.0), ("aa", -2.0), ("aaa", -3.0), ("▁", -1.0),
                  ("▁a", -2.0), ("b", -4.0), ("ab", -5.0)]
    counter = token_counts.ViterbiCounter(vocabulary)
    reference = Tokenizer(models.Unigram(vocabulary, 0, False))
    for word in ["aaaa", "aaab", "abab", "aaaaaaaaab"]:
        assert counter.word("▁" + word) == len(reference.encode("▁" + word).ids)


def test_token_counts_of_a_table(docs_of, unigram):
    got = token_counts.token_counts(docs_of(EDGES, clashing=True), PIECES).collect()
    assert Counter((r.doc_id, r.n_tokens) for r in got) == Counter(
        (d, unigram[1](t) if t else 0) for d, t in EDGES)
    assert token_counts.token_counts(docs_of([]), PIECES).count() == 0


# --- quality classifier ----------------------------------------------------------------------

def test_classifier_learns_and_leaves_edges_defined(docs_of, spark):
    rng = random.Random(2)
    good = ["the", "river", "and", "stone", "under", "light"]
    rows = [(i, " ".join(rng.choice(good) + ("###" if i % 3 == 0 else "") for _ in range(40)))
            for i in range(300)]
    labels = spark.createDataFrame(
        [(i, int(i % 3 > 0), 0) for i in range(200)] + [(None, 1, 0), (7, 0, 0), (5, None, 0)],
        "doc_id long, quality int, toxic int")
    docs = docs_of([*rows, *EDGES], clashing=True)
    fitted = quality.training_rows(docs, labels)
    assert len(fitted) == 200
    model = quality.train(fitted)
    got = quality.score_documents(docs, model).collect()
    assert len(got) == len(rows) + len(EDGES)
    held = [r for r in got if r.doc_id is not None and 200 <= r.doc_id < 300]
    assert sum((r.score >= 0.7) == (r.doc_id % 3 > 0) for r in held) >= 98
    assert all(0 <= r.score <= 1 for r in got)
    assert len(quality.training_rows(docs, labels, sample=50)) == 50
    empty = quality.train(quality.training_rows(docs, labels.limit(0)))
    assert {r.score for r in quality.score_documents(docs, empty).collect()} == {0.5}
    assert quality.score_documents(docs_of([]), model).count() == 0


def plain_training(rows, dim, epochs, rate, seed=7):
    """The same descent feature by feature, in plain Python numbers; returns the model's numbers."""
    import math

    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / dim, 1 / dim, (quality.BUCKETS + 1, dim)).tolist()
    weights, bias = [[0.0, 0.0] for _ in range(dim)], [0.0, 0.0]
    ones = sum(label for *_, label in rows)
    heavy = [min(2.0, len(rows) / 2 / max(1, n)) for n in (len(rows) - ones, ones)]
    step = 0
    for _ in range(epochs):
        for i in rng.permutation(len(rows)).tolist():
            features, counts, label = rows[i]
            now = rate * (1 - step / (epochs * len(rows))) * heavy[label]
            step += 1
            total = max(1, sum(counts))
            hidden = [sum(c / total * vectors[f][d] for f, c in zip(features, counts, strict=True))
                      for d in range(dim)]
            scores = [sum(hidden[d] * weights[d][k] for d in range(dim)) + bias[k] for k in (0, 1)]
            e = [math.exp(s - max(scores)) for s in scores]
            wrong = [e[k] / sum(e) - (k == label) for k in (0, 1)]
            back = [sum(weights[d][k] * wrong[k] for k in (0, 1)) for d in range(dim)]
            for d in range(dim):
                for k in (0, 1):
                    weights[d][k] -= now * hidden[d] * wrong[k]
            for k in (0, 1):
                bias[k] -= 0.1 * now * wrong[k]
            for f, c in zip(features, counts, strict=True):
                for d in range(dim):
                    vectors[f][d] -= now * 20 * c / total * back[d]
    return vectors, weights, bias


def test_training_equals_a_plain_descent():
    rng = random.Random(6)
    rows = []
    for i in range(40):
        text = " ".join(rng.choice(["good", "fine", "bad", "zz zz", "é"]) for _ in range(6))
        features, counts = quality.document_features(text)
        rows.append((features.tolist(), counts.tolist(), i % 3 == 0))
    arrays = [(np.array(f, np.int32), np.array(c, np.int32), int(y)) for f, c, y in rows]
    arrays.append((np.array([], np.int32), np.array([], np.int32), 1))     # an empty text
    rows.append(([], [], 1))
    model = quality.train(arrays, dim=3, epochs=2, rate=1.5)
    vectors, weights, bias = plain_training([(f, c, int(y)) for f, c, y in rows], 3, 2, 1.5)
    assert model.bias == pytest.approx(bias[1] - bias[0])
    for f in {x for features, *_ in rows for x in features} | {0, 1, quality.BUCKETS}:
        worth = sum(v * (w[1] - w[0]) for v, w in zip(vectors[f], weights, strict=True))
        assert model.worth[f] == pytest.approx(worth, abs=1e-12)


def quality_tables(spark, folder, flip_held_out=False, other=False):
    """Documents of good and bad words, and labels of most of them."""
    import zlib as z

    rng = random.Random(3)
    docs, labels = [], []
    for i in range(400):
        good = rng.random() < 0.5
        words = ["river", "garden", "letter"] if good else ["xx##", "buy!!", "zzz"]
        docs.append((i, " ".join(rng.choice(words) for _ in range(30)),
                     "q" if other else "en", "s2" if other else f"s{i % 3}", 1))
        held = z.crc32(str(i).encode()) % 4 == 2
        if i % 10:
            labels.append((i, int(good != (held and flip_held_out)), 0))
    docs += [(None, "river garden", None, None, 1), (900, None, None, None, None)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long"
                          ).coalesce(1).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").coalesce(1).write.parquet(
        f"{folder}/labels.parquet")
    return {r.doc_id: r for r in QUERIES["op9_quality_classifier"](spark, str(folder)).collect()}


def test_scores_come_from_texts_and_from_labels_not_held_out(spark, tmp_path):
    import zlib as z

    first = quality_tables(spark, tmp_path / "a")
    assert set(first) == {*range(400), None, 900}
    for i, r in first.items():
        assert r.held_out is (i is not None and z.crc32(str(i).encode()) % 4 == 2)
        assert r.predicted == int(r.score >= 0.7) and 0 <= r.score <= 1
    good = [r for r in first.values() if r.score > 0.9]
    assert 150 < len(good) < 250
    # Held-out labels, languages and sources move no score.
    second = quality_tables(spark, tmp_path / "b", flip_held_out=True, other=True)
    assert {i: r.score for i, r in second.items()} == {i: r.score for i, r in first.items()}


def test_word_by_word_score_equals_the_average():
    """Against the average of all features' vectors."""

    rng = np.random.default_rng(0)
    model = quality.Model(rng.standard_normal(quality.BUCKETS + 1), 0.3)
    score = quality._scorer(model)
    for text in ["", "a", "one two two three", "é日 é日 é日", "x" * 2000]:
        features, counts = quality.document_features(text)
        mean = (counts @ model.worth[features]) / counts.sum() if len(counts) else 0
        assert score(text) == pytest.approx(1 / (1 + np.exp(-(0.3 + mean))))


# --- tokenizer of the packing operator -------------------------------------------------------

@settings(max_examples=300, deadline=None)
@given(st.text(st.one_of(st.sampled_from("ab 'sé\n\t 　日1,.\x00"), st.characters(
    exclude_categories=["Cs"])), max_size=60))
def test_fast_ids_equal_the_tokenizers(text):
    from netrollup.llm import packing

    encode = packing.token_bytes(BPE, RANKS)
    assert memoryview(encode(text)).cast("I").tolist() == bpe().encode(
        text, add_special_tokens=False).ids


@cache
def bpe():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(BPE)


def test_paths_come_from_the_public_folder():
    assert public_tokenizers.path("byte_bpe_50k.json") == BPE
    assert hashlib.sha256(open(BPE, "rb").read()).hexdigest()
