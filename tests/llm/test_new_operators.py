"""Conversation repair, exact copies and hard negatives against brute force; nulls, ties, repeats, empties and clashes."""

import collections
import functools
import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import common, copies, near, negatives, quality, queries, repair, toxicity

SF = "/root/testdata/sf0.001"
TURNS = "conv_id long, turn long, role string, text string"


@pytest.fixture(scope="module", autouse=True)
def prepared(spark):
    common.prepare(spark)


def damaged(rows):
    out = collections.defaultdict(list)
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        own = out[conv]
        kind = zlib.crc32(":".join(" " if x is None else str(x) for x in (conv, turn)).encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        own += [(turn, "user" if kind == 4 else role, text)] * (1 + (kind == 3))
    return {c: sorted(x, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode())) for c, x in out.items()}


@functools.cache
def cheapest(letters, state):
    """(cost, audit) by trying all edits; states: '' (nothing yet), s, u, a. At most two inserts in a row can help."""
    nexts = {"": "u", "s": "u", "u": "a", "a": "u"}
    found = []
    for n in range(4):
        at = state
        for _ in range(n):
            at = nexts[at]
        cost, said = 2 * n, "I" * n
        if not letters:
            if at in ("", "a"):
                found.append((cost, said))
            continue
        (initial, gone, short), rest = letters[0], letters[1:]
        ways = [(3, "D", at)]
        if not gone:
            ways.append((2 + short, "R", nexts[at]))
            if initial == nexts[at] or (initial == "s" and at == ""):
                ways.append((short, "K", initial))
        for c, edit, to in ways:
            more, audit = cheapest(rest, to)
            found.append((cost + c + more, said + edit + audit))
    return min(found)


def brute_repair(rows):
    out = {}
    for conv, own in damaged(rows).items():
        turns = [t for t, _, _ in own if t is not None]
        n, seen, letters = collections.Counter(), set(), []
        for _, role, text in own:
            words = re.sub(r"[\x20\x09-\x0D]", "", text)
            fault = "blank" if not words else "duplicate" if (role, text) in seen else "truncated" if words[-1] not in ".!?" else ""
            seen.add((role, text))
            n[fault] += 1
            letters.append((role[:1], fault in ("blank", "duplicate"), fault == "truncated"))
        illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in itertools.pairwise(letters))
        cost, audit = cheapest(tuple(letters), "")
        lines, at, k = [], "", 0
        for edit in audit:
            if edit == "I":
                at = "a" if at == "u" else "u"
                lines.append({"u": "user:", "a": "assistant:"}[at])
                continue
            _, role, text = own[k]
            k += 1
            if edit == "R":
                at = "a" if at == "u" else "u"
                lines.append({"u": "user:", "a": "assistant:"}[at] + text)
            elif edit == "K":
                at = role[:1]
                lines.append(f"{role}:{text}")
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        out[conv] = (gaps, n["blank"], n["duplicate"], n["truncated"], illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def repaired(df):
    got = repair.digests(repair.damage(df)).collect()
    out = {r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256) for r in got}
    assert len(out) == len(got)
    return out


def test_repair_equals_brute_force(spark):
    turns = spark.read.parquet(f"{SF}/conversations.parquet")
    rows = [tuple(r) for r in turns.select("conv_id", "turn", "role", "text").collect()]
    got = repaired(turns)
    want = brute_repair(rows)
    assert got == want and sum(x[5] for x in want.values()) > 50


def test_repair_of_odd_rows(spark):
    rng = random.Random(5)
    texts = ["fine.", "short", "", " \t\x0b\n", None, "so!", "fine.", "a ", "end? \r\n", "x" * 40_000 + "."]
    roles = ["user", "assistant", "system", None, "", "User", "ua", "tool"]
    rows = [(rng.choice([None, -3, *range(40)]), rng.choice([None, *range(-2, 9)]), rng.choice(roles[:3] if rng.random() < 0.7 else roles), rng.choice(texts)) for _ in range(900)]
    rows += [(77, 4, "user", "the same.")] * 300 + [(78, t, "assistant", "the same.") for t in range(300)]
    df = spark.createDataFrame(rows, TURNS).withColumns({"audit": F.lit(1), "LETTER": F.lit("x"), "gone": F.lit(None).cast("int")})
    assert repaired(df) == brute_repair(rows)
    assert repair.digests(repair.damage(df.where("false"))).count() == 0


def test_repair_gives_rows_and_shares_suffixes(spark):
    rows = [(1, 0, "system", "Be brief."), (1, 1, "assistant", "Hello."), (1, 2, "user", "Hi!"), (2, 0, "user", "   ")]
    done = repair.Repair(repair.undamaged(spark.createDataFrame(rows, TURNS)))
    assert sorted((r.conv_id, r.place, r.edit, r.role, r.text) for r in done.rows.collect()) == [(1, 0, "K", "system", "Be brief."), (1, 1, "I", "user", ""), (1, 2, "K", "assistant", "Hello."), (1, 3, "K", "user", "Hi!"), (1, 4, "I", "assistant", "")]
    assert {(r.conv_id, r.cost, r.audit) for r in done.report.collect()} == {(1, 4, "KIKKI"), (2, 3, "D")}
    automaton = repair.Automaton()
    automaton.read("ua" * 500)
    assert automaton.nodes == 1000
    automaton.read("sU" + "ua" * 499)
    assert automaton.nodes == 1002


def brute_copies(rows):
    by = collections.defaultdict(list)
    for i, t in rows:
        by[t or ""].append(i)
    out = []
    for t, ids in by.items():
        ids.sort(key=lambda i: (i is not None, i or 0))
        sha = hashlib.sha256(t.encode()).hexdigest()
        out += [(i, ids[-1], len(ids), k == len(ids) - 1, sha) for k, i in enumerate(ids)]
    return collections.Counter(out)


@pytest.mark.parametrize("old", ["default", "all", "none", "null"])
def test_exact_copies_equal_brute_force(spark, old):
    rng = random.Random(2)
    rows = [(rng.choice([None, *range(-50, 3000)]), rng.choice([None, "", " ", "a\x00b", "ä", "ä", *(f"text {k}" for k in range(1500))])) for _ in range(4000)]
    rows += [(k, "hot") for k in range(2000)] + [(5000, "again")] * 3 + [(1, "long " * 50_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"digest": F.lit("x"), "OLD": F.lit(1), "size": F.lit(2)}).repartition(7)
    chosen = {"default": None, "all": F.lit(True), "none": F.lit(False), "null": F.lit(None).cast("boolean")}[old]
    got = copies.exact_copies(df, chosen)
    assert got.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert collections.Counter(tuple(r) for r in got.collect()) == brute_copies(rows)
    assert copies.exact_copies(df.where("false"), chosen).count() == 0


def test_perfect_hash_is_minimal_and_checked():
    rng = np.random.default_rng(4)
    for n in (0, 1, 2, 65, 5000):
        digests = rng.integers(0, 256, (n, 32), np.uint8)
        table = copies.PerfectHash.read(copies.PerfectHash.of(digests).blob())
        assert sorted(table.slots(digests).tolist()) == list(range(n))
        assert (table.slots(rng.integers(0, 256, (50, 32), np.uint8)) < max(n, 1)).all()
    same = np.repeat(rng.integers(0, 256, (1, 32), np.uint8), 9, axis=0)
    same[:, 0] = range(9)  # no level can separate these: the words that are hashed are equal
    table = copies.PerfectHash.read(copies.PerfectHash.of(same).blob())
    assert len(table.rest) == 9 and sorted(table.slots(same).tolist()) == list(range(9))


def test_look_ups_of_which_none_is_in_history(spark):
    rows = [(k, f"text {k}") for k in range(40)]
    got = copies.exact_copies(spark.createDataFrame(rows, "doc_id long, text string"), F.col("doc_id") < 20)
    assert collections.Counter(tuple(r) for r in got.collect()) == brute_copies(rows)


def test_strassen_is_exact():
    rng = np.random.default_rng(1)
    for m, n, d, leaf in ((1, 1, 1, 32), (70, 90, 64, 8), (33, 129, 65, 32), (100, 37, 41, 1), (5, 300, 768, 4)):
        a, b = rng.integers(-(2**24), 2**24, (m, d)), rng.integers(-(2**24), 2**24, (n, d))
        assert (negatives.product(a, b, leaf) == a @ b.T).all()
    big = np.full((64, 64), 2**27)
    assert (negatives.product(big, big, 4) == 64 * 2**54).all()


def brute_negatives(rows, every):
    sound = []
    for k, (i, v, label) in enumerate(rows):
        if label is not None and v and all(x is not None and np.isfinite(x) for x in v):
            q = [int(np.floor(256 * float(x))) for x in v]
            if sum(x * x for x in q) < 2**62:
                sound.append((k, i, q, label))
    key = lambda x: (-x[0], x[1] is None, x[1] or 0)
    out = []
    for k, i, q, label in sound:
        if i is None or i % every:
            continue
        others = [(sum(a * b for a, b in zip(q, r, strict=True)), j, other) for n, j, r, other in sound if n != k and len(r) == len(q)]
        for score, p, _ in sorted((x for x in others if x[2] == label), key=key)[:5]:
            near = sorted((x for x in others if x[2] != label and 80 * score <= 100 * x[0] <= 100 * score), key=key)[:5]
            out += [(i, p, n + 1, x[1], score, x[0]) for n, x in enumerate(near)]
    return collections.Counter(out)


@pytest.mark.parametrize("kind", ["float", "double"])
def test_hard_negatives_equal_brute_force(spark, kind, monkeypatch):
    monkeypatch.setattr(negatives, "ANCHORS", 20)
    monkeypatch.setattr(negatives, "CANDIDATES", 90)
    rng = np.random.default_rng(8)
    rows = [(int(rng.integers(0, 400)), rng.normal(0, 0.1, 33).astype(np.float32).tolist(), int(rng.integers(-1, 3))) for _ in range(500)]
    rows += [(k, rows[0][1], k % 2) for k in range(600, 700)]  # a group of equal vectors, with ties
    rows += [(None, rows[3][1], 1), (4, None, 1), (8, [], 1), (12, [None] * 33, 1), (16, [float("nan")] * 33, 2), (20, [float("-inf")] * 33, 2), (24, rows[5][1], None), (28, [3e38] * 33, 1), (32, [0.5] * 7, 1), (36, [0.5] * 7, 2), (40, [0.5] * 7, 1)]
    df = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>, label int").withColumns({"row": F.lit("a"), "TIE": F.lit(1), "task": F.lit(0)})
    got = collections.Counter(tuple(r) for r in negatives.hard_negatives(df, anchor_every=4).collect())
    assert got == brute_negatives(rows, 4) and len(got) > 500
    assert negatives.hard_negatives(df.where("false")).count() == 0


@pytest.mark.parametrize("name", ["op12_exact_copies", "op13_hard_negatives"])
def test_queries_equal_their_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    got = queries.QUERIES[name](spark, SF)
    cur = con.execute(queries.ORACLE[name])
    order = [[d[0] for d in cur.description].index(c) for c in got.columns]
    assert collections.Counter(tuple(r) for r in got.collect()) == collections.Counter(tuple(r[k] for k in order) for r in cur.fetchall())


def brute_classes(rows):
    """(doc_id, class_id, n_links) of each row by all pairs of rows, whatever their ids."""

    def shingled(text):
        w = (text or "").lower().split()
        k = min(5, len(w))
        return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if w else frozenset()

    sets, root, links = [shingled(t) for _, t in rows], list(range(len(rows))), [0] * len(rows)

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and both >= 0.8 * (len(sets[a]) + len(sets[b]) - both):
                links[a] += 1
                links[b] += 1
                root[find(a)] = find(b)
    ids = collections.defaultdict(list)
    for k, (i, _) in enumerate(rows):
        ids[find(k)].append(i)
    least = {k: min((i for i in x if i is not None), default=None) for k, x in ids.items()}
    return sorted(((i, least[find(k)] if sets[k] else i, links[k]) for k, (i, _) in enumerate(rows)), key=str)


def test_near_copies_of_shared_and_null_ids(spark):
    text = lambda k, n=40: " ".join(f"t{k}w{i}" for i in range(n))
    rows = [(5, text(1)), (5, text(2)), (6, text(2) + " more"), (7, text(1) + " more"), (None, text(2) + " other"), (None, text(3)), (None, text(3) + " x"), (None, text(3)), (9, ""), (None, ""), (None, " "), (9, "")]
    rows += [(100, text(1000 + k)) for k in range(60)] + [(200 + k, text(1000 + k) + " y") for k in range(30)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"rep": F.lit("r"), "_ID": F.lit(1), "low": F.lit(2)}).repartition(5)
    want = brute_classes(rows)
    assert sorted(((r.doc_id, r.class_id, r.n_links) for r in near.near_copies(df).collect()), key=str) == want
    kept = near.keep_one(df)
    assert kept.columns == df.columns
    got = collections.Counter((r.doc_id, r.text) for r in kept.collect())
    expected = collections.Counter([(5, text(1)), (5, text(2)), (9, ""), (None, ""), (None, " "), *[(100, text(1000 + k)) for k in range(60)]])
    extra = got - expected
    assert not expected - got and sum(extra.values()) == 1 and next(iter(extra))[0] is None and next(iter(extra))[1].startswith(text(3))


def test_toxicity_sample_is_bounded(spark):
    many = [(1, f"text {k}") for k in range(3000)] + [(2, "again and again")] * 3000 + [(k, f"own {k}") for k in range(3, 40)] + [(90, "long " * 2000), (91, None)]
    docs = spark.createDataFrame(many, "doc_id long, text string").repartition(6)
    labels = spark.createDataFrame([(1, 1), (2, 0), (90, 0), (91, 1), (50, 1), *[(k, k % 2) for k in range(3, 40)]], "doc_id long, toxic int")
    got = toxicity.sampled(docs, labels, 25, 1_000)
    assert len(got) == len(set(got)) and all(sum(k == kind for _, k in got) <= 25 and sum(len(t) for t, k in got if k == kind) <= 1_000 for kind in (0, 1))
    assert sum(t == "again and again" for t, _ in got) <= 1 and not any(t.startswith("long") for t, _ in got)
    whole = toxicity.sampled(docs.where("doc_id > 2"), labels, 100, 10**6)
    assert sorted(whole) == sorted([(f"own {k}", k % 2) for k in range(3, 40)] + [("long " * 2000, 0), ("", 1)])


def test_toxicity_score_and_spans_by_enumeration(spark, monkeypatch):
    """Marginals by all label sequences of each line, hence the document's score and the offsets of its likely tokens."""
    rng = np.random.default_rng(6)
    made = toxicity.Field(rng.normal(0, 2, toxicity.BUCKETS).astype(np.float32), np.array([[0.0, -1.1], [0.4, 0.9]]), -0.3, (-1.0, 0.6, 0.8, 1.5))
    monkeypatch.setattr(toxicity, "fit", lambda *a, **k: made)
    texts = ["one Two, three\n\nfour five", "", None, " \n ", "x1 -- abcdefgh abcdefgi\tabc", "solo", "A　b c\nd e f g h"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in toxicity.toxicity(docs, spark.createDataFrame([], "doc_id long, toxic int")).collect()}

    def emission(word):
        w = max(re.findall(r"[^\W\d_]+", word.lower()), key=len, default="")
        names = [f"w {w}", *[f"{k} {w[:k]}" for k in (3, 4, 5, 6) if len(w) >= k]] if w else ["none"]
        return sum(float(made.weights[toxicity.bucket(n)]) for n in names)

    for k, text in enumerate(texts):
        odds = []
        for line in (text or "").split("\n"):
            e = [emission(w) for w in line.split()]
            if not e:
                continue
            on, whole = np.zeros(len(e)), 0.0
            for y in itertools.product((0, 1), repeat=len(e)):
                chance = np.exp(made.start * y[0] + np.dot(e, y) + sum(made.step[a, b] for a, b in itertools.pairwise(y)))
                whole += chance
                on += chance * np.array(y)
            odds += np.log(on / (whole - on)).tolist()
        x = np.array(odds)
        parts = [1.0, float(np.clip(x.max(), -8, 8)), np.log1p((1 / (1 + np.exp(-x))).sum()), min(1.0, 20 * (1 / (1 + np.exp(-x))).mean())] if len(x) else [1.0, -8.0, 0.0, 0.0]
        assert abs(got[k].score - 1 / (1 + np.exp(-np.dot(parts, made.final)))) < 1e-9, text
        runs = []
        for n, m in enumerate(re.finditer(r"\S+", text or "")):
            if x[n] > 0:
                if runs and n and x[n - 1] > 0:
                    runs[-1][1] = m.end()
                else:
                    runs.append([m.start(), m.end()])
        assert got[k].spans == ",".join(f"{a}:{b}" for a, b in runs)


def test_quality_posterior_by_texts(spark):
    """Votes from the texts by plain Python, and expectation-maximisation over texts instead of patterns of votes."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    blank, ids, votes, base = re.compile(r"[\x20\x09-\x0D]+"), [], [], []
    vote = lambda bad, good: -1 if bad else int(good)
    for r in docs.collect():
        x = r.text or ""
        w = [t for t in blank.split(x) if t]
        lines = [t for t in x.split("\n") if blank.sub("", t)]
        tri = collections.Counter(zip(w, w[1:], w[2:], strict=False))
        again = len({k for i, t in enumerate(zip(w, w[1:], w[2:], strict=False)) if tri[t] > 1 for k in (i, i + 1, i + 2)})
        chars, n, symbols, dup = sum(map(len, w)), len(w), sum(c in "#*$%&|<>" for c in x), len(lines) - len(set(lines))
        upper, marks, stops = sum("A" <= c <= "Z" for c in x), sum(c in "!?" for c in x), x.count(".")
        symbol_words = sum(any(c in "#*$%&|<>" for c in t) for t in w)
        ids.append(r.doc_id)
        base.append(n < 50 or 100 * again > 50 * n)
        votes.append(
            [
                vote(symbols * 100 > chars * 5, symbols * 200 < chars), vote(symbol_words * 100 > n * 20, symbol_words * 100 < n * 2), vote(upper * 100 > chars * 40, upper * 100 < chars * 15), vote(marks * 100 > n * 25, marks * 100 < n * 5),
                vote(stops * 100 < n, stops * 40 > n), vote(dup * 100 > len(lines) * 30 and dup >= 3, dup == 0), vote(again * 100 > n * 30, again * 100 < n * 10),
            ]
        )
    v, start = np.array(votes) + 1, np.array(quality.START)
    weight, share = quality.PRIOR * len(v) + 1, 0.8
    chance = np.repeat(start[None], v.shape[1], 0)  # rule, kind, vote
    log_odds = lambda: np.log(share / (1 - share)) + sum(np.log(chance[r, 1, v[:, r]] / chance[r, 0, v[:, r]]) for r in range(v.shape[1]))
    for _ in range(quality.ROUNDS):
        p = 1 / (1 + np.exp(-log_odds()))
        kinds = np.array([0.2, 0.8]) * weight + [(1 - p).sum(), p.sum()]
        seen = np.stack([[np.bincount(v[:, r], weights=q, minlength=3) for q in (1 - p, p)] for r in range(v.shape[1])]) + start * weight
        share, chance = kinds[1] / kinds.sum(), seen / seen.sum(2, keepdims=True)
    want = {i: (x, bool(not b and x >= 0.5)) for i, x, b in zip(ids, 1 / (1 + np.exp(-log_odds())), base, strict=True)}
    got = {r.doc_id: r for r in quality.quality(docs).select("doc_id", "posterior", "kept").collect()}
    assert got.keys() == want.keys() and all(abs(got[i].posterior - x) < 1e-6 and got[i].kept == k for i, (x, k) in want.items())
    assert 0.5 < sum(k for _, k in want.values()) / len(want) < 1
