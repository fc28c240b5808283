"""Components, near-duplicate texts and vectors, and repeated passages, against brute force."""

from __future__ import annotations

import random
import time
import re
from collections import defaultdict

import numpy as np
from tests_llm_data import ODD, sentence, texts_like_prose, words

from loadwarden.llm import minhash, substring_dedup, vectors
from loadwarden.llm import rows as row_helpers
from loadwarden.llm.components import components


class Forest(dict):
    def find(self, x):
        while self.setdefault(x, x) != x:
            x = self[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self[max(a, b)] = min(a, b)


def test_components(spark):
    rng = random.Random(1)
    chain = [(i, i + 1) for i in range(100, 160)]
    star = [(500, 500 + i) for i in range(1, 40)]
    edges = chain + star + [(rng.randint(0, 90), rng.randint(0, 90)) for _ in range(45)]
    edges += [(7, 7), (-3, 4), (None, 5), (200, None)]
    found = components(spark.createDataFrame(edges, "a long, b long"))
    forest = Forest()
    for a, b in edges:
        if a is not None and b is not None and a != b:
            forest.join(a, b)
    assert {tuple(r) for r in found.collect()} == {(x, forest.find(x)) for x in list(forest)}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


# --- near-duplicate texts


def _shingles(text):
    low = (text or "").translate({c: c + 32 for c in range(65, 91)})
    found = re.findall(r"[^\x20\x09-\x0D]+", low)
    if 0 < len(found) < 5:
        return frozenset([tuple(found)])
    return frozenset(tuple(found[i : i + 5]) for i in range(len(found) - 4))


def _near(rows):
    sets = {i: _shingles(t) for i, t in rows if i is not None}
    forest = Forest({i: i for i in sets})
    ids = sorted(sets)
    for k, i in enumerate(ids):
        for j in ids[:k]:
            common = len(sets[i] & sets[j])
            if common and 100 * common >= 85 * len(sets[i] | sets[j]):
                forest.join(i, j)
    return {i: (len(sets[i]), forest.find(i), forest.find(i) == i) for i in sets}


def _copied(n_base, n_copies, seed=2):
    """Texts and copies with some words changed, so that similarities lie around the threshold."""
    rng = random.Random(seed)
    rows = texts_like_prose(n_base, first=100, seed=seed)
    number = 10_000
    for _, text in list(rows):
        for _ in range(rng.randint(0, n_copies)):
            new = text.split(" ")
            for _ in range(rng.randint(0, max(1, len(new) // 40))):
                new[rng.randrange(len(new))] = words(rng, 1)[0]
            rows.append((number, " ".join(new) if rng.random() < 0.8 else text.upper()))
            number += 1
    rng.shuffle(rows)
    return rows


def test_near_duplicates_are_those_of_all_pairs(make_docs, monkeypatch):
    rows = ODD + _copied(40, 5)
    base = " ".join(words(random.Random(8), 120)).split(" ")
    rng = random.Random(9)
    for i in range(90):  # a large group whose members are linked with some of the others only
        new = list(base)
        for _ in range(rng.randint(0, 4)):
            new[rng.randrange(len(new))] = words(rng, 1)[0]
        rows.append((20_000 + i, " ".join(new)))
    monkeypatch.setattr(minhash, "LIST_BLOCK", 16)
    monkeypatch.setattr(minhash, "SET_BLOCK", 16)
    found = minhash.near_duplicates(make_docs(rows)).collect()
    assert len(found) == len(rows)
    expected = _near(rows)
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in found if r.doc_id is not None} == expected
    assert [(r.n_shingles, r.component_id, r.kept) for r in found if r.doc_id is None] == [(4, None, True)]
    assert 40 < sum(kept for *_, kept in expected.values()) < len(expected) - 60


def test_dropping_near_duplicates_keeps_the_rest(make_docs):
    docs = make_docs(ODD + [(50, "Same  words HERE for\nall of you"), (51, None)])
    kept = minhash.drop_near_duplicates(docs)
    assert kept.schema == docs.schema
    assert sorted((r.doc_id or -1) for r in kept.collect()) == [-1, 1, 2, 3, 4, 5, 7, 8, 51]
    assert minhash.drop_near_duplicates(docs.limit(0)).collect() == []


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_exploded_postings_are_not_broadcast(make_docs):
    classes = row_helpers.stored(minhash.signed(make_docs(texts_like_prose(30, first=1, seed=3))), "classes")
    posted = minhash._posted(classes.selectExpr("doc_id as node", "signature"), 40)
    plan = _plan(posted)
    # Spark takes the 64 postings of a document to be as large as one row.
    assert "BroadcastHashJoin" not in plan and plan.count("SortMergeJoin") == 1


def test_many_rows_are_joined_without_a_broadcast(spark, make_docs, monkeypatch):
    docs = row_helpers.stored(make_docs(_copied(20, 3)), "docs")
    chain = spark.range(20).selectExpr("id as a", "id + 1 as b")
    found = [{tuple(r) for r in f(docs).collect()} for f in (minhash.near_duplicates, minhash.drop_near_duplicates)]
    few = _plan(minhash.drop_near_duplicates(docs))
    monkeypatch.setattr(row_helpers, "BROADCAST_ROWS", 3)
    many = _plan(minhash.drop_near_duplicates(docs))
    assert (few.count("BroadcastHashJoin"), many.count("BroadcastHashJoin")) == (1, 0)
    assert "BroadcastHashJoin" not in _plan(minhash.near_duplicates(docs))
    assert [{tuple(r) for r in f(docs).collect()} for f in (minhash.near_duplicates, minhash.drop_near_duplicates)] == found
    assert {tuple(r) for r in components(chain).collect()} == {(x, 0) for x in range(21)}


def test_links_from_four_fifths_on(make_docs):
    rng, rows, between = random.Random(12), [], 0
    for i in range(60):  # one pair each, whose similarity lies between 0.74 and 0.9
        base = words(rng, 150)
        new = list(base)
        for at in rng.sample(range(8), rng.randint(2, 5)):
            new[10 + 17 * at] = "changed"
        pair = [(2 * i, " ".join(base)), (2 * i + 1, " ".join(new))]
        a, b = (_shingles(text) for _, text in pair)
        between += 80 <= 100 * len(a & b) / len(a | b) < 85
        rows += pair
    gone = set()
    for (i, x), (j, y) in zip(rows[::2], rows[1::2]):
        a, b = _shingles(x), _shingles(y)
        if 100 * len(a & b) >= 80 * len(a | b):
            gone.add(j)
    assert between >= 10 and len(gone) < 60
    kept = minhash.drop_near_duplicates(make_docs(rows), (80, 100))
    assert {r.doc_id for r in kept.collect()} == {i for i, _ in rows} - gone
    assert minhash.least_matches((85, 100)) == 40 and minhash.least_matches((80, 100)) == 35


def test_equal_doc_ids_are_one_document(make_docs):
    rows = [(3, "a b c d e f g"), (3, "p q r s t u v"), (5, "a b c d e f g"), (4, "p q r s t u v")]
    found = minhash.near_duplicates(make_docs(rows)).collect()
    assert sorted((r.doc_id, r.component_id, r.kept) for r in found) == [
        (3, 3, True), (3, 3, True), (4, 3, False), (5, 3, False),
    ]


# --- near-duplicate vectors


def _vectors(seed=3, dim=16):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(150, dim))
    near = [b + rng.normal(size=dim) * s for b in base[:40] for s in (0.1, 0.2, 0.25)]
    tight = [base[50] + rng.normal(size=dim) * 0.12 for _ in range(120)]
    around = [base[50] + rng.normal(size=dim) * 0.5 for _ in range(40)]
    rows = [(i, [float(np.float32(v)) for v in x]) for i, x in enumerate([*base, *near, *tight, *around])]
    n = len(rows)
    rows += [(n + i, rows[i][1]) for i in range(30)] + [(n + 40, [2 * v for v in rows[0][1]])]
    nan = float("nan")
    rows += [(n + 50, None), (n + 51, []), (n + 52, [0.0] * dim), (n + 53, [nan] + [1.0] * (dim - 1))]
    rows += [(n + 54, [None] + [1.0] * (dim - 1)), (n + 55, [1.0, 2.0]), (n + 56, [1.0, 2.0]), (n + 57, [1e300] * dim)]
    rows += [(n + 58, [float("inf")] * dim), (None, [1.0, -1.0]), (None, None)]
    return rows


def test_vector_links_are_those_of_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(vectors, "CELL_SIZE", 40)
    monkeypatch.setattr(vectors, "BLOCK", 16)
    rows = _vectors()
    schema = "vec_id long, embedding array<double>, label int, node int, cell int"
    found = vectors.near_vectors(spark.createDataFrame([(*r, 1, 2, 3) for r in rows], schema)).collect()
    assert len(found) == len(rows)
    usable = {}
    for i, v in rows:
        if i is not None and v and None not in v and np.isfinite(v).all() and any(v):
            x = np.array(v) / max(map(abs, v))
            usable[i] = x / np.sqrt(x @ x)
    links, forest = defaultdict(set), Forest({i: i for i, _ in rows if i is not None})
    for i, x in usable.items():
        for j, y in usable.items():
            if i != j and len(x) == len(y) and x @ y >= 0.9:
                links[i].add(j)
                forest.join(i, j)
    got = {r.vec_id: r for r in found if r.vec_id is not None}
    hit = sum(got[i].n_links for i in links)
    assert all(got[i].n_links <= len(links[i]) for i in got)
    assert hit >= 0.99 * sum(map(len, links.values()))
    wrong = [i for i in got if got[i].component_id != forest.find(i)]
    assert len(wrong) <= 2
    assert all(r.kept == (r.vec_id is None or r.component_id == r.vec_id) for r in found)
    assert vectors.near_vectors(spark.createDataFrame([], schema)).collect() == []


# --- repeated passages


def _repeats(rows, least):
    ordered = sorted(rows, key=lambda r: (r[0] is None, r[0]))
    first, found = {}, set()
    for i, (doc_id, text) in enumerate(ordered):
        for k, u in enumerate(substring_dedup.units(text or "")):
            first.setdefault(u[3], (i, k))
    for i, (doc_id, text) in enumerate(ordered):
        run = []
        for k, u in [*enumerate(substring_dedup.units(text or "")), (None, None)]:
            if u and first[u[3]] != (i, k):
                run.append(u)
                continue
            if sum(n for _, _, n, _ in run) >= least:
                found |= {(doc_id, a, b) for a, b, _, _ in run}
            run = []
    return found


def test_units_cover_sentences():
    text = "Eins zwei.  Drei?! \n\n...\nvier \"fünf.\" sechs"
    assert [text[a:b] for a, b, _, _ in substring_dedup.units(text)] == ["Eins zwei.", "Drei?!", "vier \"fünf.\"", "sechs"]
    a, b = substring_dedup.units("A  b, c.")[0], substring_dedup.units("\ta B c")[0]
    assert a[3] == b[3] and a[2] == 3


def test_repeats_are_found_wherever_they_stand(make_docs):
    rng = random.Random(6)
    passage = " ".join(sentence(rng, 9) for _ in range(7))
    rows = [r for r in ODD if r[0] != 8] + texts_like_prose(20, first=50)
    for i in range(6):
        rows.append((100 + i, f"{sentence(rng)} {passage} {sentence(rng)}\n{sentence(rng)}"))
    rows += [(200, "Of it. " * 30 + "\n" + sentence(rng)), (201, f"{sentence(rng, 5)} And so on."), (202, "And so on. Else.")]
    found = {(r.doc_id, r.start, r.end) for r in substring_dedup.find_repeats(make_docs(rows)).collect()}
    distinct = [r for r in rows if r[0] != 6] + [(6, None)]
    assert found == _repeats(distinct, 20)
    assert {100 + i for i in range(6)} & {d for d, *_ in found} == {101, 102, 103, 104, 105}
    clean = {i for i, _ in rows if i is not None and 50 <= i < 100} | {201, 202}
    assert not clean & {d for d, *_ in found}
    done = {r.doc_id: r for r in substring_dedup.remove_repeats(make_docs(rows)).collect()}
    assert len(done) == len({i for i, _ in rows})
    for i, text in rows:
        kept = text
        for a, b in sorted(((a, b) for d, a, b in found if d == i), reverse=True):
            kept = kept[:a] + kept[b:]
        assert done[i].text == kept
        assert [tuple(x) for x in done[i].removed_ranges] == sorted((a, b) for d, a, b in found if d == i)
    assert substring_dedup.find_repeats(make_docs(rows).limit(0)).collect() == []


def test_repeated_whole_lines_go_whatever_their_length(make_docs):
    rng = random.Random(14)
    own = [sentence(rng) for _ in range(20)]
    two = "Read on. See below."
    rows = [
        (1, f"{own[0]} All rights reserved. {own[1]}\nTop\n{two}"),
        (2, f"{own[2]}\nAll rights reserved.\n  TOP \n{own[3]}"),
        (3, f"All rights  reserved.\n{own[4]} {two}\n{two}\nTop"),
        (4, f"{own[5]} Read on. {own[6]}\nSee below.\nTop\n\n{two}\nTop"),
        (None, f"{own[7]}\n{own[8]}\nRead on, see below"),
    ]
    seen, gone = set(), set()
    for doc_id, text in rows:
        at = 0
        for line in text.split("\n"):
            key = tuple(re.findall(r"\w+", line.lower()))
            if key and key in seen:
                gone.add((doc_id, at + len(line) - len(line.lstrip()), at + len(line.rstrip())))
            seen.add(key)
            at += len(line) + 1
    assert len(gone) == 8
    done = substring_dedup.remove_repeats(make_docs(rows), whole_lines=True).collect()
    found = substring_dedup.find_repeats(make_docs(rows), whole_lines=True).collect()
    assert {i for i, _, _ in gone} == {r.doc_id for r in found}
    for r in done:
        kept = dict(rows)[r.doc_id]
        covered = {p for a, b in r.removed_ranges for p in range(a, b) if not kept[p].isspace()}
        expected = {p for i, a, b in gone if i == r.doc_id for p in range(a, b) if not kept[p].isspace()}
        assert covered == expected
    assert substring_dedup.find_repeats(make_docs(rows)).collect() == []


def test_long_passages_inside_sentences_are_found(make_docs):
    rng = random.Random(15)
    passages = [words(rng, n) for n in (50, 50, 64, 120)]
    rows = []
    for i in range(16):  # no sentence end at or in the passage
        parts = words(rng, 7 + i % 5) + passages[i % 4] + words(rng, 6 + i % 3)
        rows.append((300 + i, f"{sentence(rng)} {' '.join(parts)}. {sentence(rng)}"))
    # Brute force: the words in windows of 20 that stood in an earlier text.
    seen, again = set(), {}
    for doc_id, text in rows:
        spans = [m.span() for m in re.finditer(r"\w+", text)]
        run = [tuple(text[a:b].lower() for a, b in spans[i : i + 20]) for i in range(len(spans) - 19)]
        again[doc_id] = {k for i, w in enumerate(run) if w in seen for k in range(i, i + 20)}
        seen |= set(run)
    done = {r.doc_id: r for r in substring_dedup.remove_repeats(make_docs(rows)).collect()}
    for doc_id, text in rows:
        spans = [m.span() for m in re.finditer(r"\w+", text)]
        ranges = [tuple(x) for x in done[doc_id].removed_ranges]
        gone = {k for k, (a, b) in enumerate(spans) if any(x <= a and b <= y for x, y in ranges)}
        assert all(b <= c for (_, b), (c, _) in zip(ranges, ranges[1:]))
        assert gone <= again[doc_id] and len(gone) >= len(again[doc_id]) - 23
        assert bool(gone) == (doc_id >= 304)
    found = substring_dedup.find_repeats(make_docs([*rows, (400, "ab cd ef " * 40)])).collect()
    within = [(r.start, r.end) for r in found if r.doc_id == 400]
    assert 60 <= min(a for a, _ in within) < 100 and 300 < max(b for _, b in within) <= 360
    found = [r for r in found if r.doc_id != 400]
    assert all(r.words == len(re.findall(r"\w+", dict(rows)[r.doc_id][r.start : r.end])) for r in found)


def test_chinese_and_japanese_sentences(make_docs):
    rng = random.Random(16)
    han = lambda n: "".join(chr(rng.randrange(0x4E00, 0x9000)) for _ in range(n))
    passage = "".join(f"{han(6)}，{han(7)}。" for _ in range(6))
    rows = [(1, f"{han(9)}。{passage}{han(8)}！"), (2, f"{han(12)}？「{han(5)}。」{passage}{han(9)}。"), (3, f"{han(9)}。{han(9)}。")]
    done = {r.doc_id: r for r in substring_dedup.remove_repeats(make_docs(rows)).collect()}
    assert done[1].text == rows[0][1] and done[3].text == rows[2][1]
    assert done[2].text == rows[1][1].replace(passage, "")
    assert [u[:3] for u in substring_dedup.units("日本語。かな、abc def！")] == [(0, 4, 3), (4, 15, 4)]


def test_runs_of_marks_take_linear_time():
    text = "Word" + "." * 1_000_000 + "x and " + "。" + "!?" * 300_000 + "y end."
    begin = time.process_time()
    found = substring_dedup.units(text)
    assert time.process_time() - begin < 5 and found[-1][1] == len(text)
    plain = "Word" + "." * 1_000_000 + "x. Next..) one"
    begin = time.process_time()
    assert [u[1] for u in substring_dedup.units(plain)][-1] == len(plain)
    assert time.process_time() - begin < 3


def test_a_unit_in_a_third_of_all_rows(make_docs):
    rng = random.Random(21)
    common = sentence(rng, 25)
    rows = [(i, common + "\n" + "\n".join(sentence(rng) for _ in range(2))) for i in range(200)]
    rows += [(i, rows[i - 300][1]) for i in range(300, 330)]
    docs = make_docs(rows).repartition(3)
    found = substring_dedup.hashed_units(docs.selectExpr("doc_id as _row_id", "doc_id", "text"))
    hot = substring_dedup.hot_digests(found)
    assert [bytes(r.digest) for r in hot.collect()].count(substring_dedup.units(common)[0][3]) == 1
    gone = {(r.doc_id, r.start) for r in substring_dedup.find_repeats(docs).collect()}
    assert {(i, 0) for i in (*range(1, 200), *range(300, 330))} <= gone and (0, 0) not in gone
    assert all(len([g for g in gone if g[0] == i]) == 3 for i in range(300, 330))


def test_of_equal_texts_one_row_stays_whatever_its_id(make_docs):
    text = "one two three four five six seven"
    rows = [(None, text), (None, text), (9, text), (4, text), (4, text), (None, "p q r s t u v"), (None, "p q r s t u v")]
    kept = minhash.drop_near_duplicates(make_docs(rows + [(1, None), (1, None), (2, "")]))
    assert sorted(map(repr, ((r.doc_id, r.text) for r in kept.collect()))) == sorted(
        map(repr, [(4, text), (None, "p q r s t u v"), (1, None), (1, None), (2, "")])
    )
