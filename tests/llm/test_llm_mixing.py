"""Mixing sources: targets, whole passes and cuts, shards and their quotas."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from tests_llm_data import ODD, words

from loadwarden.llm import mixing
from loadwarden.llm import rows as row_helpers


def _filled(sizes, weights, repeats):
    """Targets by giving out what is left again and again until no source is above its limit."""
    target, open_ = {s: 0.0 for s in sizes}, set(sizes)
    left = float(sum(sizes.values()))
    while left > 1e-9 and open_:
        total = sum(weights[s] for s in open_)
        share = {s: left * weights[s] / total for s in open_}
        left = 0.0
        for s, more in share.items():
            target[s] += more
            if target[s] >= repeats * sizes[s]:
                left += target[s] - repeats * sizes[s]
                target[s] = float(repeats * sizes[s])
                open_.discard(s)
    return target


def _documents():
    rng = random.Random(1)
    rows = []
    for i in range(120):
        source = rng.choice(["a", "a", "a", "a", "b", "c", "d", None])
        rows.append((i, " ".join(words(rng, rng.randint(0, 60))), None, source))
    rows.append((500, " \t ".join(words(rng, 700)) + "\n", None, "e"))
    rows += [(600, "just two", None, "f"), (601, None, None, "g"), (601, None, None, "g")]
    return rows + [(None if i is None else 1000 + i, t, None, "odd") for i, t in ODD[:-1]]


def test_targets_and_taken_words(make_docs):
    rows = _documents()
    sizes = mixing.measured(make_docs(rows))
    targets = mixing.source_targets(sizes)
    blocks = mixing.mix_blocks(sizes, targets, block_words=50, shards=5).cache()
    by_source = Counter()
    for _, text, _, source in rows:
        by_source[source] += len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    order = sorted(by_source, key=lambda s: (s is None, s))
    weights = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    expected = _filled(dict(by_source), weights, 3)
    found = {r.source: r for r in targets.collect()}
    assert set(found) == set(by_source)
    for s, row in found.items():
        assert row.source_size == by_source[s]
        assert row.target == pytest.approx(expected[s])
    done = mixing.taken_words(sizes, targets, blocks).collect()
    assert len(done) == len(rows)
    assert all(0 <= r.taken <= 3 * r.size for r in done)
    of_doc = {i: s for i, _, _, s in rows if i is not None}
    taken = Counter()
    for r in done:
        if r.doc_id in of_doc:
            taken[of_doc[r.doc_id]] += r.taken
    for s in set(by_source) - {"odd"}:
        assert abs(taken[s] - expected[s]) <= 0.5 + 1e-9

    # No word of a pass is dealt out twice, shards are even, and their quotas add up.
    pieces = blocks.collect()
    spans = defaultdict(list)
    for p in pieces:
        spans[p._row_id, p["pass"]].append((p.start, p.start + p.words))
    for parts in spans.values():
        parts.sort()
        assert all(a[1] <= b[0] for a, b in zip(parts, parts[1:]))
    per_shard = Counter(p.shard for p in pieces)
    assert set(per_shard) == set(range(5))
    assert max(per_shard.values()) - min(per_shard.values()) <= 3
    places = defaultdict(list)
    for p in pieces:
        places[p.shard].append(p.position)
    assert all(sorted(x) == list(range(len(x))) for x in places.values())


def test_reruns_agree_and_seeds_differ(make_docs):
    docs = make_docs(_documents())

    def mixed(seed):
        return sorted(
            (r.doc_id or -1, r.text)
            for r in mixing.mix_documents(docs, block_words=20, shards=3, seed=seed).collect()
        )

    assert mixed(1) == mixed(1) != mixed(2)


def test_mixed_documents_are_their_blocks(make_docs):
    rows = _documents()
    docs = make_docs(rows)
    mixed = mixing.mix_documents(docs, block_words=50, shards=4)
    assert mixed.schema == docs.schema
    texts = defaultdict(list)
    for doc_id, text, _, _ in rows:
        texts[doc_id].append(text)
    kept = mixed.collect()
    for r in kept:
        assert r.n_chars == len(r.text)
        assert any(r.text in (t or "") for t in texts[r.doc_id])
    assert any(r.text == texts[r.doc_id][0] for r in kept)


def test_nothing_to_mix(make_docs):
    empty = make_docs([(1, "a")]).limit(0)
    assert mixing.mix_documents(empty).collect() == []
    blank = make_docs([(1, None, None, "a"), (2, " ", None, None)])
    sizes = mixing.measured(blank)
    targets = mixing.source_targets(sizes)
    done = mixing.taken_words(sizes, targets, mixing.mix_blocks(sizes, targets)).collect()
    assert sorted((r.doc_id, r.size, r.target, r.taken) for r in done) == [(1, 0, 0.0, 0), (2, 0, 0.0, 0)]
    with pytest.raises(ValueError):
        mixing.source_targets(sizes, (1, 0))


def test_draws_follow_the_hypergeometric_distribution(spark):
    for marked, total, n in ((30, 100, 40), (5, 10**9, 5 * 10**8), (0, 5, 2), (5, 5, 3), (400, 900, 450)):
        uniform = spark.range(4000).select(((F.col("id") + 0.5) / 4000).alias("u"))
        draw = mixing.hypergeometric(F.lit(marked), F.lit(total), F.lit(n), F.col("u"))
        found = np.array([r.x for r in uniform.select(draw.alias("x")).collect()])
        share = marked / total
        assert abs(found.mean() - n * share) < 0.02 * max(1, n * share)
        variance = n * share * (1 - share) * (total - n) / (total - 1)
        assert abs(found.var() - variance) < 0.05 * max(1, variance)


def test_only_dataframe_functions(make_docs):
    sizes = mixing.measured(make_docs(_documents()))
    targets = mixing.source_targets(sizes)
    plan = mixing.mix_blocks(sizes, targets)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def test_ranges_of_shards_and_one_very_long_text(make_docs, monkeypatch):
    rows = _documents() + [(2000, "w " * 200_000 + "end \n", None, "long")]
    docs = make_docs(rows)

    def mixed():
        return sorted((r.doc_id or -1, r.text) for r in mixing.mix_documents(docs, block_words=50, shards=3).collect())

    whole = mixed()
    monkeypatch.setattr(mixing, "RANGE_WORDS", 1000)
    assert mixed() == whole
    targets = {r.source: r.target for r in mixing.source_targets(mixing.measured(docs)).collect()}
    assert abs(sum(len(t.split()) for i, t in whole if i == 2000) - targets["long"]) <= 0.5 + 1e-9


def test_many_blocks_are_joined_without_a_broadcast(make_docs, monkeypatch):
    docs = row_helpers.stored(make_docs(_documents()), "docs")

    def mixed():
        df = mixing.mix_documents(docs, block_words=50, shards=3)
        return df._jdf.queryExecution().executedPlan().toString(), Counter((r.doc_id, r.text) for r in df.collect())

    few, expected = mixed()
    monkeypatch.setattr(row_helpers, "BROADCAST_ROWS", 3)
    many, found = mixed()
    # The rows of sources and shards are broadcast in both.
    assert (few.count("BroadcastHashJoin"), many.count("BroadcastHashJoin")) == (2, 1)
    assert found == expected
