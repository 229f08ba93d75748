"""The text operators against brute-force versions on small fixtures with nulls, repeats, ties, empty and long texts."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
import xxhash

import corpus_pipeline
from tallyward.llm import decontaminate, line_dedup, near_copies, quality_rules, simhash, suffix_dedup
from tallyward.llm.components import components
from tallyward.llm.suffix_array import equal_runs, suffix_array

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
NO_ID = (1 << 63) - 1


def prose(rng: random.Random, words: int) -> str:
    made = ["".join(rng.choice(["th", "er", "é", "on", "An", "ñ", "st"]) for _ in range(rng.randint(1, 4))) for _ in range(words)]
    return "".join(w + rng.choice([" ", " ", " ", ".\n"]) for w in made)


@pytest.fixture(scope="module")
def documents(spark):
    """Copies, near copies, shared passages, an id twice, NULLs, empty, blank, very short and long texts; clashing extra columns."""
    rng = random.Random(5)
    passage = prose(rng, 60)
    base = [prose(rng, rng.choice([3, 20, 80, 300])) for _ in range(40)]
    rows = list(enumerate(base))
    rows += [(100, base[3]), (101, base[4] + " end"), (102, passage), (103, prose(rng, 30) + passage + prose(rng, 30))]
    rows += [(104, "x " + passage + " y"), (105, None), (106, ""), (107, " \n\t\n"), (108, "a"), (109, "two words")]
    rows += [(110, "one " * 4000), (111, prose(rng, 9000)), (None, base[5]), (None, None), (112, base[6]), (112, base[6]), (112, base[7])]
    rows += [(200 + k, prose(rng, 12) + "Licensed to all.\nUse it.\nShare it with everyone you know.\n" + prose(rng, 12)) for k in range(80)]
    return spark.createDataFrame([(i, t, 1, 2, "x") for i, t in rows], "doc_id long, text string, n_words int, n_runs int, fp string").repartition(5)


def collected(docs):
    return [(r.doc_id, r.text) for r in docs.collect()]


def test_quality_rules(spark, documents):
    def brute(text):
        text = text or ""
        w = re.findall(r"[^\x20\x09-\x0d]+", text)
        lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0d]", x)]
        seen = Counter(zip(w, w[1:], w[2:]))
        covered = {j for i in range(len(w) - 2) if seen[w[i], w[i + 1], w[i + 2]] > 1 for j in (i, i + 1, i + 2)}
        base = len(w) < 50 or 100 * len(covered) > 50 * len(w)
        return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered), base

    rules = quality_rules.default_rules()
    want = Counter((i, *brute(t)) for i, t in collected(documents))
    results = [quality_rules.cascade(documents, order=order).collect() for order in (rules, rules[::-1])]
    for rows in results:
        assert Counter((r.doc_id, *(r[c] for c in quality_rules.BASE), r.base_failed) for r in rows) == want
        assert not any(r.kept and r.base_failed for r in rows)
    # The verdict does not depend on the order of the rules.
    assert Counter((r.doc_id, r.kept) for r in results[0]) == Counter((r.doc_id, r.kept) for r in results[1])


def test_quality_rules_are_ordered_by_rejection_per_cost(spark, documents):
    rules = quality_rules.default_rules()
    order = quality_rules.ordered(documents, rules)
    assert sorted(r.name for r in order) == sorted(r.name for r in rules)
    never = {"ellipsis", "bullets"}  # reject nothing here, so they come after what rejects
    names = [r.name for r in order]
    assert names.index("few_words") < min(names.index(n) for n in never)


def test_decontamination(spark, documents):
    docs = collected(documents)
    long_ = next(t for i, t in docs if i == 111).split()
    items = [(1, " ".join(long_[50:75])), (2, "two words"), (3, ""), (4, None), (None, "one one"), (5, next(t for i, t in docs if i == 102)), (5, "again " * 12), (6, "One")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOW))
    windows = defaultdict(set)
    for i, t in items:
        w = split(t)
        for k in range(len(w) - min(10, len(w)) + 1) if w and i is not None else ():
            windows[tuple(w[k : k + min(10, len(w))])].add(str(i))
    lengths = {len(w) for w in windows}
    want = Counter()
    for i, t in docs:
        w = split(t)
        spots = [(k, n) for n in lengths for k in range(len(w) - n + 1) if tuple(w[k : k + n]) in windows]
        hits = {p for k, n in spots for p in range(k, k + n)}
        found = {x for k, n in spots for x in windows[tuple(w[k : k + n])]}
        want[i, len(w), len(hits), ",".join(sorted(found)), bool(hits)] += 1
    rows = decontaminate.decontaminate(documents, benchmark).collect()
    assert Counter((r.doc_id, r.n_words, r.n_hit, ",".join(r.item_ids), r.contaminated) for r in rows) == want
    kept = decontaminate.keep_clean(documents, benchmark)
    assert kept.columns == documents.columns and kept.count() == sum(n for k, n in want.items() if not k[4])


def test_decontamination_without_items(spark, documents):
    empty = spark.createDataFrame([], "item_id long, text string")
    assert not any(r.contaminated for r in decontaminate.decontaminate(documents, empty).collect())


def test_line_dedup(spark, documents):
    docs = {(i is None, NO_ID if i is None else i, xxhash.xxh64_intdigest((t or "\0null").encode()), t) for i, t in collected(documents)}
    # Rows of one id are in the order of their text's hash; a window seen before, in that order, goes.
    def signed(t):
        h = 42 if t is None else xxhash.xxh64_intdigest(t.encode(), 42)
        return h - (1 << 64) if h >> 63 else h

    seen, want = set(), {}
    for n, i, _, t in sorted(docs, key=lambda d: (d[0], d[1], signed(d[3]))):
        lines = (t or "").split("\n")
        at = [k for k, x in enumerate(lines) if re.search(r"[^\x20\x09-\x0d]", x)]
        starts, gone = [], set()
        for k in range(len(at) - 2):
            window = tuple(lines[j] for j in at[k : k + 3])
            if window in seen:
                starts.append(k)
                gone |= set(at[k : k + 3])
            seen.add(window)
        runs = sum(k == 0 or s - starts[k - 1] > 3 for k, s in enumerate(starts))
        want[None if n else i, t] = ("\n".join(x for k, x in enumerate(lines) if k not in gone), len(at), len(gone), runs)
    expected = Counter((i, *want[i, t]) for i, t in collected(documents))
    out = line_dedup.dedup_lines(documents)
    assert set(documents.columns) <= set(out.columns)
    assert Counter((r.doc_id, r.text, r.n_lines, r.n_removed, r.n_runs) for r in out.collect()) == expected
    assert sum(v[2] for v in want.values()) > 100


def test_line_dedup_of_long_passages(spark):
    """One or two lines of over 50 words are runs too where asked: brute force over all windows, and passages planted by hand."""
    rng = random.Random(8)
    line = lambda n: " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))
    one, fifty, short, left, right = line(51), line(50), line(4), line(30), line(21)
    rows = [(1, one), (2, f"{line(3)}\n{one}\n{line(3)}"), (3, one), (4, f"{fifty}\n{line(9)}"), (5, fifty), (6, f"{left}\n\n{right}\nx"), (7, f"y\n{left}\n{right}")]
    rows += [(8, f"{short}\n{line(2)}"), (9, short), (10, f"{one}\n{short}"), (11, f"{line(1)}\n{one}\n{short}"), (12, f"{line(60)}\n" + one), (13, None), (None, one), (14, "")]
    rows += [(15 + k, "\n".join(rng.choice([one, fifty, short, left, right, "z", " "]) for _ in range(rng.randint(1, 7)))) for k in range(60)]
    seen, want = set(), Counter()
    for i, t in sorted(rows, key=lambda d: (d[0] is None, d[0] or 0)):
        lines = (t or "").split("\n")
        at, gone = [k for k, x in enumerate(lines) if x.strip()], set()
        for k in range(len(at)):
            for size in (1, 2, 3):
                window = tuple(lines[j] for j in at[k : k + size])
                if len(window) == size and (size == 3 or len(" ".join(window).split()) > 50):
                    gone |= set(at[k : k + size]) if window in seen else set()
                    seen.add(window)
        places = [k for k, j in enumerate(at) if j in gone]
        want[i, "\n".join(x for k, x in enumerate(lines) if k not in gone), len(places), sum(k - 1 not in places for k in places)] += 1
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    out = line_dedup.dedup_lines(docs, passage=50).collect()
    assert Counter((r.doc_id, r.text, r.n_removed, r.n_runs) for r in out) == want
    text = {r.doc_id: r.text for r in out}
    assert text[3] == "" and text[None] == "" and text[5] == fifty and text[7] == "y" and text[9] == short and text[11].count("\n") == 0


def brute_print(text, size):
    w = re.findall(r"[^\x20\x09-\x0d]+", (text or "").translate(LOW))
    if not w:
        return 0
    shingles = [" ".join(w[i : i + size]) for i in range(len(w) - size + 1)] or [" ".join(w)]
    h = np.array([xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles], np.uint64)
    bits = 2 * np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=int) > len(h)
    return int(np.packbits(bits, bitorder="little").view(np.uint64)[0])


def test_simhash(spark, documents):
    docs = collected(documents)
    prints = [brute_print(t, 3) for _, t in docs]
    group = list(range(len(docs)))
    for a in range(len(docs)):
        for b in range(a):
            if (prints[a] ^ prints[b]).bit_count() <= 2 and group[a] != group[b]:
                group = [group[b] if g == group[a] else g for g in group]
    least = {g: min((docs[k][0] for k in range(len(docs)) if group[k] == g and docs[k][0] is not None), default=None) for g in group}
    want = Counter((docs[k][0], f"{prints[k]:016x}", least[group[k]]) for k in range(len(docs)))
    rows = simhash.near_duplicates(documents).collect()
    assert Counter((r.doc_id, r.fingerprint, r.component_id) for r in rows) == want
    kept = simhash.keep_one(documents)
    assert kept.columns == documents.columns and kept.distinct().count() == len(set(group))


def test_simhash_links_every_close_fingerprint(spark):
    rng = random.Random(3)
    seeds = [rng.getrandbits(64) for _ in range(30)] + [0, (1 << 64) - 1, 1 << 63, (1 << 63) - 1]
    prints = {s ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for s in seeds for _ in range(6)} | set(seeds)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    found = simhash.links(spark.createDataFrame([(p,) for p in signed], "fp long")).collect()
    parent = {p: p for p in signed}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for r in found:
        assert ((r.hi ^ r.lo) & ((1 << 64) - 1)).bit_count() <= 2
        parent[root(r.hi)] = root(r.lo)
    for a in signed:
        for b in signed:
            if ((a ^ b) & ((1 << 64) - 1)).bit_count() <= 2:
                assert root(a) == root(b)


def test_near_copies_at_every_similarity(spark):
    """Planted near copies from 0.6 to 1 against all pairs; SimHash at two bits finds few of them."""
    rng = random.Random(11)
    word = lambda: f"w{rng.randrange(10**6)}"
    texts = [None, "", " \n", "a b", "A  b", "a b c", "a b c d e f", "A b c d e f"]
    for _ in range(25):
        base = [word() for _ in range(rng.choice([30, 90, 400]))]
        for _ in range(5):
            changed = {rng.randrange(len(base)) for _ in range(int(len(base) * rng.choice([0, 0.005, 0.015, 0.02, 0.03, 0.05])))}
            texts.append(" ".join(word() if k in changed else w for k, w in enumerate(base)))
    hot = [word() for _ in range(300)]
    texts += [" ".join([*hot[:k], word(), *hot[k + 1 :]]) for k in range(60)]

    def shingles(text):
        w = re.findall(r"[^\x20\x09-\x0d]+", (text or "").translate(LOW))
        return {tuple(w[k : k + 5]) for k in range(len(w) - 4)} or {tuple(w)} - {()}

    sets, group = [shingles(t) for t in texts], list(range(len(texts)))
    for a in range(len(sets)):
        for b in range(a):
            if group[a] != group[b] and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]):
                group = [min(group[a], group[b]) if g in (group[a], group[b]) else g for g in group]
    rows = [(k, t, "en", "x", len(t or "")) for k, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(5)
    marked = near_copies.near_copies(docs).collect()
    assert {r.doc_id: r.component_id for r in marked} == dict(enumerate(group))
    kept = near_copies.keep_one(docs)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == sorted(set(group))
    assert near_copies.keep_one(docs.limit(0)).count() == 0
    bits = [brute_print(t, 3) for t in texts]
    assert sum((bits[k] ^ bits[g]).bit_count() > 2 for k, g in enumerate(group)) > 20


def test_near_copies_in_a_crowd(spark):
    """Documents that share most words but are no copies fill the cells; the planted pairs among them are found, and candidates grow with the rows."""
    rng = random.Random(3)
    word = lambda: f"w{rng.randrange(10**6)}"
    blocks = [[word() for _ in range(10)] for _ in range(30)]
    made = {}
    for size in (150, 300):
        texts = []
        for k in range(size):  # eight blocks in ten are everyone's: unlike sets with a similarity of about 0.55
            own = [b if rng.random() < 0.8 else [word() for _ in b] for b in blocks]
            texts.append([w for b in own for w in b])
        pairs = []
        for k in range(0, 60, 2):
            near = list(texts[k])
            for at in rng.sample(range(0, 300, 30), 6):  # six words in 300 touch thirty shingles: a similarity of about 0.82
                near[at] = word()
            texts[k + 1] = near
            pairs.append((k, k + 1))
        docs = spark.createDataFrame([(k, " ".join(t)) for k, t in enumerate(texts)], "doc_id long, text string").repartition(3)
        prints = near_copies.shingle_sets(docs)
        sets = near_copies.stored(prints.selectExpr("key", "n", "sketch", "struct(false as unknown, doc_id, text_hash) as first"), "test")
        made[size] = near_copies.candidates(sets).count()
        group = {r.doc_id: r.component_id for r in near_copies.near_copies(docs).collect()}
        whole = [{tuple(t[k : k + 5]) for k in range(len(t) - 4)} for t in texts]
        alike = [(a, b) for a in range(size) for b in range(a) if 5 * len(whole[a] & whole[b]) >= 4 * len(whole[a] | whole[b])]
        assert len(alike) >= len(pairs) // 2
        assert sum(group[a] == group[b] for a, b in alike) >= 0.9 * len(alike)
    assert all(n <= 3 * size for size, n in made.items())  # all pairs would be 75 and 150 a document


def test_repeated_rows_are_thinned_to_one(spark):
    text = "one two three four five six seven eight nine ten eleven twelve"
    rows = [(None, text)] * 4 + [(None, text + " more")] * 3 + [(7, "x y z")] * 5 + [(8, None)] * 2 + [(9, "a b")]
    docs = spark.createDataFrame([(i, t, "n") for i, t in rows], "doc_id long, text string, stays string").repartition(4)
    for kept in (simhash.keep_one(docs), near_copies.keep_one(docs), near_copies.keep_one(docs, among=simhash.near_duplicates(docs))):
        got = sorted(map(repr, collected(kept)))
        assert kept.columns == docs.columns and len(got) == len(set(got)) and {repr((7, "x y z")), repr((8, None)), repr((9, "a b"))} <= set(got)
        assert sum("'one" in g for g in got) in (1, 2)


def test_components_of_a_long_chain(spark):
    edges = [(k + 1, k) for k in range(200)] + [(1001, 1000), (1003, 1002), (1003, 1001)]
    random.Random(1).shuffle(edges)
    rows = components(spark.createDataFrame(edges, "hi long, lo long")).collect()
    assert {r.hi: r.lo for r in rows} == {**{k: 0 for k in range(1, 201)}, 1001: 1000, 1002: 1000, 1003: 1000}
    assert len(rows) == 203


def test_suffix_array_and_runs():
    rng = np.random.default_rng(2)
    for _ in range(200):
        text = rng.integers(97, 97 + rng.integers(1, 5), rng.integers(1, 150)).astype(np.uint8)
        raw = text.tobytes()
        order = suffix_array(text, 256)
        assert order.tolist() == sorted(range(len(raw)), key=lambda k: raw[k:])
        whole = order[order <= len(raw) - 12]
        runs = equal_runs(whole, text, 12)
        assert [raw[a : a + 12] == raw[b : b + 12] for a, b in zip(whole, whole[1:])] == (runs[1:] == runs[:-1]).tolist()


@pytest.mark.parametrize("hot", [2, 64])
def test_suffix_dedup(spark, documents, hot, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "HOT", hot)
    docs = [(NO_ID if i is None else i, (t or "").encode()) for i, t in collected(documents)]
    first = {}
    for i, b in docs:
        for k in range(len(b) - 49):
            first[b[k : k + 50]] = min(i, first.get(b[k : k + 50], NO_ID))
    want = Counter()
    for i, b in docs:
        gone = np.zeros(len(b), bool)
        for k in range(len(b) - 49):
            if first[b[k : k + 50]] < i:
                gone[k : k + 50] = True
        kept = np.frombuffer(b, np.uint8)[~gone].tobytes()
        spans = len(re.findall(b"\x01+", gone.astype(np.uint8).tobytes()))
        want[None if i == NO_ID else i, len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()] += 1
    rows = suffix_dedup.dedup_strings(documents, digest=True).collect()
    assert Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows) == want


@pytest.mark.parametrize("buckets", [4, (1 << 24) + 3, (1 << 31) - 1])
def test_anchors_are_recognised_at_any_number_of_buckets(buckets):
    rng = np.random.default_rng(1)
    text = rng.integers(97, 123, 5000).astype(np.uint8)
    others = [rng.integers(97, 123, n).astype(np.uint8) for n in (700, 0, 49, 50)]
    packs = []
    for number, texts in enumerate(([text, *others[:2]], [*others[2:], text[100:4000]])):
        ids, offsets = np.arange(len(texts)) + 10 * number, np.concatenate([[0], np.cumsum([len(t) for t in texts])])
        packs.append(suffix_dedup.pack(ids, np.concatenate(texts), offsets)[:2])
    batch = pa.record_batch([pa.array([n for n, _ in packs]), pa.array([b for _, b in packs], pa.binary())], ["pack", "blob"])
    held = pd.concat([b.to_pandas() for b in suffix_dedup._pack_anchors(buckets)(iter([batch]))])
    told = pd.concat([suffix_dedup._shared_anchors(g) for _, g in held.groupby("bucket")])
    told["kind"], told["place"] = suffix_dedup.SHARED, None
    found = []
    for number, blob in packs:
        ids, data, offsets = suffix_dedup.unpack(blob)
        doc, _, name, lo, hi, _ = suffix_dedup.Shared(told[told["pack"] == number], buckets).segments(data, offsets)
        found.append({data[a:b].tobytes() for a, b in zip(lo, hi)})
        assert all(offsets[d] <= a and b <= offsets[d + 1] for d, a, b in zip(doc, lo, hi))
    assert found[0] & found[1] and sum(map(len, found[0] & found[1])) >= 3900  # every string of the passage is in a segment of both


def test_empty_tables(spark, documents):
    none = documents.limit(0)
    items = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert quality_rules.cascade(none, order=quality_rules.default_rules()).count() == 0
    assert decontaminate.decontaminate(none, items).count() == 0
    assert line_dedup.dedup_lines(none).count() == 0
    assert simhash.near_duplicates(none).count() == 0
    assert suffix_dedup.dedup_strings(none).count() == 0
