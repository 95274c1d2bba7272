"""Ranked search, license scan and conversation repair against brute force, SQL, and odd rows."""

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter

import pytest
from compare import connect, differences
from pyspark.sql import functions as F

from countyloom.llm import conversation_repair as repair
from countyloom.llm import license_scan, queries, ranked_search

SF = "/root/testdata/sf0.001"
LONG = "gnu general public license " * 3 + "ab " * 400_000 + "MIT License"
ODD_TEXTS = ["", None, " \t\n", "one", "MIT license", "mit license", "Ärger 日本語 cc-by CC BY", "x" * 5_000_000, LONG, "The mit License, the MIT LICENSE", "cc cc by"]


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, t, "own") for i, t in enumerate([*ODD_TEXTS, *ODD_TEXTS])] + [(None, "no id mit", "own"), (3, "one", "own"), (3, "one", "own")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, score string")
    return frame.withColumns({c: F.lit("own") for c in ("rank", "_words", "_hits", "_base", "_id", "_known", "item_id", "labels")}).coalesce(2)


@pytest.mark.parametrize("name", ["op11_ranked_search", "op12_license_scan", "op13_conversation_repair"])
def test_queries_equal_their_sql(spark, name):
    assert differences(queries.QUERIES[name](spark, SF), connect(SF), queries.oracle_sql()[name]) == []


# --- ranked search


def ranked(docs, items, k):
    """All scores, by the formula."""
    read = [(i, re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))) for i, t in docs]
    n, total = sum(bool(t) for _, t in read), sum(len(t) for _, t in read)
    df = Counter(w for _, t in read for w in set(t))
    out = []
    for item, text in items:
        asked = set(re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").lower()))
        scores = []
        for doc, terms in read:
            tf = Counter(terms)
            m = 100 - 90 + (90 * len(terms) * n) // max(1, total)
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[w] + 1))) * ((10**9 * tf[w]) // (1000 * tf[w] + 8 * m)) for w in asked & set(tf))
            if score > 0:
                scores.append((-score, doc is None, doc or 0))
        out += [(item, r, None if null else doc, -s) for r, (s, null, doc) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=repr)


def test_search_equals_all_scores(spark, monkeypatch):
    rng = random.Random(3)
    words = [f"w{int(rng.paretovariate(0.6))}" for _ in range(400)] + ["É", "the"]
    docs = [(i, " ".join(rng.choices(words, k=rng.choice([1, 5, 60])))) for i in range(500)]
    docs += [(1000 + i, docs[7][1]) for i in range(200)] + [(None, docs[7][1]), (7, docs[7][1])]
    items = [(j, " ".join(rng.choices(words, k=1 + j % 12))) for j in range(30)] + [(90, docs[7][1]), (91, "absent"), (92, "")]
    monkeypatch.setattr(ranked_search, "BATCH_ITEMS", 13)
    frames = spark.createDataFrame(docs, "doc_id long, text string").repartition(3), spark.createDataFrame(items, "item_id long, text string")
    found = ranked_search.search(*frames, k=5)
    assert sorted(map(tuple, found.collect()), key=repr) == ranked(docs, items, 5)


def test_small_blocks_give_the_same(spark):
    rng = random.Random(5)
    docs = [(i, " ".join(rng.choices("abcdefgh", k=6))) for i in range(300)]
    items = [set(w.encode() for w in pair) for pair in itertools.combinations("abcdefgh", 3)]
    import numpy as np
    import pandas as pd

    terms = {d: ranked_search.terms_of(t) for d, t in docs}
    df = Counter(w for t in terms.values() for w in set(t))
    stats = ranked_search.Statistics(300, 1800, {w: math.floor(1000 * math.log(602 / (2 * n + 1))) for w, n in df.items()})
    numbers = {t: i for i, t in enumerate(sorted(stats.weights))}
    weights = np.array([stats.weights[t] for t in numbers])
    frame = pd.DataFrame({"_id": [d for d, _ in docs], "_known": True, "text": [t for _, t in docs]})
    ((block, ids, _),) = ranked_search._blocks(iter([frame]), numbers, stats, weights)
    asked = [np.array(sorted(numbers[t] for t in i)) for i in items]
    got = block.best(asked, 10, [1] * len(asked))
    want = ranked(docs, [(i, b" ".join(t).decode()) for i, t in enumerate(items)], 10)
    assert sorted([(i, r, ids[d], s) for i, g in enumerate(got) for r, (s, d) in enumerate(g, 1)], key=repr) == want


def test_search_of_odd_rows(spark, odd):
    items = odd.select(F.col("doc_id").alias("item_id"), F.substring("text", 1, 100).alias("text"), "score")
    found = sorted(map(tuple, ranked_search.search(odd, items.where("item_id in (3, 4)")).collect()), key=repr)
    docs = [(r.doc_id, r.text) for r in odd.select("doc_id", "text").collect()]
    wanted = [(r.item_id, r.text) for r in items.where("item_id in (3, 4)").collect()]
    assert found == ranked(docs, wanted, 10) and len(found) > 10
    assert ranked_search.search(odd.where("false"), items).count() == 0
    assert ranked_search.search(odd, items.where("false")).columns == ["item_id", "rank", "doc_id", "score"]


# --- license scan


def scanned(text):
    """(words, places of phrases, matched (label, start)) by looking at every window."""
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    base = []
    for phrase, label in license_scan.PHRASES.items():
        p = phrase.split(" ")
        base += [(i, label) for i in range(len(words)) if words[i] == p[0] and words[i : i + len(p)] == p]
    met = set()
    for t in license_scan.TEMPLATES:
        step, whole = len(t.words), set(t.words)
        for start in range(0, len(words), step):
            share = len(whole & set(words[start : start + 2 * step])) / len(whole)
            if share >= license_scan.THRESHOLD - 1e-12:
                met.add((t.label, start, round(share, 9)))
    return len(words), sorted(base), sorted(met)


def test_scan_equals_every_window(spark):
    rng = random.Random(2)
    filler = [w for t in license_scan.TEMPLATES for w in t.words] + ["mit", "prose", "words"] * 40
    texts = []
    for i in range(400):
        words = rng.choices(filler, k=rng.choice([3, 30, 120]))
        if i % 3 == 0:
            t = list(rng.choice(license_scan.TEMPLATES).words)
            for _ in range(rng.randrange(6)):
                t[rng.randrange(len(t))] = "changed"
            at = rng.randrange(len(words))
            words[at:at] = t
        texts.append(" ".join(words))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    for source in (docs, docs.where("doc_id < 5")):  # ranks only order the work
        found = license_scan.scan(docs, license_scan.rank_words(source)).collect()
        for r in found:
            n, base, met = scanned(r.text)
            got = {(m.label, m.start, round(m.score, 9)) for m in r._matches}
            assert (r._n_words, sorted((b.start, b.label) for b in r._base), sorted(got)) == (n, base, met)
    assert sum(len(r._matches) for r in found) > 100


def test_scan_of_odd_rows(odd):
    ranks = license_scan.rank_words(odd)
    found = license_scan.digest(license_scan.scan(odd, ranks))
    rows = {r.doc_id: r for r in found.collect()}
    for i, text in enumerate(ODD_TEXTS):
        n, base, _ = scanned(text)
        labels = sorted({label for _, label in base})
        starts = [s for s, _ in base] or [None]
        r = rows[i]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == (n, len(base), starts[0], starts[-1], ",".join(labels))
        assert (r.score == 1.0) == bool(base) and set(labels) <= set(r.labels.split(","))
    assert found.count() == odd.count() and license_scan.digest(license_scan.scan(odd.where("false"), ranks)).count() == 0
    assert all(v >= 0 for v in license_scan.rank_words(odd.where("false")).values())


# --- conversation repair


def cheapest(shape):
    """Least cost and audit by tables from the end; up to five rows added at a place."""
    far = (10**9, "")
    after = None
    for i in range(len(shape), -1, -1):
        now = [far] * 4
        if i == len(shape):
            now = [(0, ""), far, far, (0, "")]
        else:
            for q, a, c, e in repair._row_edges(shape[i]):
                now[q] = min(now[q], (c + after[a][0], e + after[a][1]))
        for _ in range(5):
            for q, a, c, e in repair._ADDED:
                now[q] = min(now[q], (c + now[a][0], e + now[a][1]))
        after = now
    return after[0]


def test_least_edits_equal_tables():
    for n in range(4):
        for letters in itertools.product("suaxSUAX-", repeat=n):
            shape = "".join(letters)
            assert repair.least_edits(shape) == cheapest(shape)
    rng = random.Random(1)
    for n in [12] * 2000 + [3000]:
        shape = "".join(rng.choices("uauaUA-sx", k=n))
        assert repair.least_edits(shape) == cheapest(shape)


def expected(rows):
    """Everything the query gives, for rows (conv_id, turn, role, text) with distinct turns."""
    out = {}
    for conv in {r[0] for r in rows}:
        kept = []
        for c, turn, role, text in rows:
            if c != conv:
                continue
            role, text = " " if role is None else role, " " if text is None else text
            name = f"{' ' if c is None else c}:{' ' if turn is None else turn}"
            kind = zlib.crc32(name.encode()) % 20
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            kept += [(turn, "user" if kind == 4 else role, text)] * {0: 0, 3: 2}.get(kind, 1)
        kept.sort(key=lambda r: (r[0] is not None, r[0] or 0))
        seen, shape, counts = set(), "", Counter()
        for _, role, text in kept:
            last = re.sub(r"[\x20\x09-\x0D]", "", text)[-1:]
            fault = "blank" if not last else "duplicate" if (role, text) in seen else "truncated" if last not in ".!?" else ""
            seen.add((role, text))
            counts[fault] += 1
            first = role[:1] if role[:1] in ("s", "u", "a") else "x"
            shape += "-" if fault in ("blank", "duplicate") else first.upper() if fault else first
        pairs = [a[1][:1] + b[1][:1] for a, b in itertools.pairwise(kept)]
        turns = [t for t, _, _ in kept if t is not None]
        cost, audit = cheapest(shape)
        fixed, rest = [], iter(kept)
        for edit in audit:
            opened = bool(fixed) and fixed[0].startswith("s")
            wanted = "assistant" if (len(fixed) - opened) % 2 else "user"
            if edit == "I":
                fixed.append(wanted + ":")
                continue
            _, role, text = next(rest)
            if edit != "D":
                fixed.append(f"{wanted if edit == 'R' else role}:{text}")
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(p not in ("su", "ua", "au") for p in pairs)
        digest = hashlib.sha256("\n".join(fixed).encode()).hexdigest()
        out[conv] = (gaps, counts["blank"], counts["duplicate"], counts["truncated"], illegal, cost, audit, digest)
    return out


def test_repair_of_odd_conversations(spark):
    rng = random.Random(4)
    roles = ["user", "assistant", "system", "tool", "", None, "User"]
    texts = ["a.", "b!", "cut short", " \t", "", None, "same?", "same?", "é. \n", "x" * 1_000_000 + "."]
    rows = [(c, t, rng.choice(roles[:2] * 4 + roles), rng.choice(texts)) for c in [*range(80), None] for t in rng.sample([None, *range(12)], k=rng.randrange(1, 9))]
    rows += [(500, t, ["user", "assistant"][t % 2], f"row {t}{'.' if t % 9 else ''}") for t in range(30_000)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumns({c: F.lit("own") for c in ("_key", "audit", "place")})
    found = repair.digest(repair.damaged(frame.repartition(5)))
    assert {r.conv_id: tuple(r)[1:] for r in found.collect()} == expected(rows)
    assert repair.digest(repair.damaged(frame.where("false"))).count() == 0
    whole = repair.repaired_rows(frame, repair.plan_repairs(frame)).where("_key = '=500'").orderBy("place").collect()
    assert [r.place for r in whole] == list(range(len(whole))) and [r.role[0] for r in whole] == ["u", "a"] * (len(whole) // 2)


def test_equal_turns_and_repeated_rows(spark):
    rows = [(1, 0, "user", "hi."), (1, 0, "user", "hi."), (1, 0, "assistant", "hello."), (1, None, "system", "be good.")]
    frame = spark.createDataFrame(rows, "conv_id int, turn int, role string, text string")
    (plan,) = repair.plan_repairs(frame).collect()
    assert (plan.duplicate, plan.gaps) == (1, 0)
    assert (plan.cost, plan.audit) == cheapest("sau-")
    more = repair._Seen()
    more.MOST = 4
    hashes = [i * 7 % 50 for i in range(200)]
    assert [more.add(h) for h in hashes] == [h not in hashes[:i] for i, h in enumerate(hashes)]
