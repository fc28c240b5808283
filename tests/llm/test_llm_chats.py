"""Conversation tries, chat formatting and phrases against brute force."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tests_llm_data import ODD
from tokenizers import Tokenizer

from loadwarden.llm import chat_format, collocations, prefix_trie
from loadwarden.llm.turns import Runs

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.fixture(scope="module")
def make_chats(spark):
    """Conversations of (conv_id, turn, role, text), dealt over several tasks, with columns that clash."""

    def make(rows):
        schema = "conv_id bigint, turn bigint, role string, text string, depth int, part string, n int, single int"
        return spark.createDataFrame([(*row, 7, "p", 8, 9) for row in rows], schema).repartition(3)

    return make


def in_turn(rows):
    """The (role, text) of each conversation in the order that is defined for ties."""
    found = defaultdict(list)
    for conv_id, turn, role, text in rows:
        role, text = role or "", text or ""
        said = f"{len(role.encode())}:{role}{text}".encode()
        found[conv_id].append(((turn is not None, turn or 0), hashlib.md5(said).digest(), role, text))
    return {c: [(role, text) for *_, role, text in sorted(turns)] for c, turns in found.items()}


def trie(talks):
    """Rows of the trie of {conv_id: [(role, text)]}, by going through all prefixes."""
    members = defaultdict(list)
    for c, turns in talks.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        leaves[node] = sum(leaves[k] for k in children[node]) or 1
        own = (len(members[node]) - 1) * len(node[-1][1]) if node else 0
        saved[node] = own + sum(saved[k] for k in children[node])
    return sorted(
        (
            (
                min(m), len(node), min(members[node[:-1]]) if node else None, len(m), len(children[node]),
                leaves[node], saved[node], sha(",".join(map(str, sorted(c for c in m if len(talks[c]) == len(node))))),
            )
            for node, m in members.items()
        ),
        key=repr,
    )


def rebuilt(talks):
    found = {}
    for c, turns in talks.items():
        h = zlib.crc32(str(c).encode()) % 6
        found[c] = talks.get(c - c % 100, [])[:h] + turns[h:]
    return found


TRIE = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def nodes(df):
    return sorted((tuple(row) for row in df.select(*TRIE).collect()), key=repr)


def random_talks(n=150, seed=5):
    """Conversations of few different turns, so that they share prefixes of all lengths and some are alike."""
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(1000), n):
        for turn in range(rng.choice([1, 2, 3, 5, 9])):
            text = rng.choice(["a", "bb", "é😀"]) if rng.random() < 0.8 else f"own {c} {turn}"
            rows.append((c, turn, rng.choice(["user", "assistant"]) if turn > 2 else "user", text))
    return rows


def test_trie_of_random_conversations(make_chats):
    rows = random_talks()
    assert nodes(prefix_trie.conversation_trie(make_chats(rows))) == trie(in_turn(rows))


def test_rebuilt_trie_with_odd_rows(make_chats):
    rows = random_talks(60, 6) + [
        (300, 0, "user", "first of a hundred"), (305, 0, "user", "x"), (305, 1, None, None), (305, 1, "user", "tie"),
        (305, None, "system", "before"), (305, 1, "user", "tie"), (None, 0, "user", "of none"), (2007, 0, "user", ""),
        (2008, 3, "user", "alone"), (9_000_000_000, 0, "user", "far"),
    ]
    rows += [(4000, t, "user", f"t{t}") for t in range(300)] + [(4001, t, "user", f"t{t}") for t in range(299)]
    expected = trie(rebuilt({c: t for c, t in in_turn(rows).items() if c is not None}))
    assert nodes(prefix_trie.rebuilt_trie(make_chats(rows))) == expected


def test_a_full_sketch_proves_less_and_changes_nothing(spark, make_chats):
    rows = random_talks(80, 7)
    turns, convs = prefix_trie.number_turns(make_chats(rows))
    slim = turns.selectExpr("conv_id", "_part", "_at + 1 as depth", "digest", "chars")
    prefixes = prefix_trie.with_prefixes(slim, convs.selectExpr("conv_id", "n as length"))
    sketch = prefix_trie.count_prefixes(prefixes)
    seen = prefix_trie.screened(prefixes, sketch)
    alone = seen.where("single").count()
    # What is proved to be single is, and so small a sketch misses next to nothing here.
    counts = prefixes.groupBy("x1", "x2").count().where("count = 1").count()
    assert 0.9 * counts <= alone <= counts
    sketch.twice[:] = 255
    assert not sketch.single(*(np.arange(9, dtype=np.int64),) * 2).any()


def test_hot_nodes_and_one_conversation_alone(make_chats):
    rows = [(c, t, "user", f"t{t}") for c in range(200) for t in range(3)]
    rows += [(c, 3, "user", f"{c % 70}") for c in range(150)]
    assert nodes(prefix_trie.conversation_trie(make_chats(rows))) == trie(in_turn(rows))
    one = [(5, 0, "user", "x"), (5, 1, "user", "y")]
    assert nodes(prefix_trie.conversation_trie(make_chats(one))) == trie(in_turn(one))


def test_no_conversations(spark, make_chats):
    none = make_chats([(1, 0, "user", "x")]).where("conv_id > 1")
    assert nodes(prefix_trie.rebuilt_trie(none)) == []
    formatted = chat_format.format_conversations(none, TOKENIZER)
    assert chat_format.read_digests(formatted, TOKENIZER).collect() == []


def test_places_go_on_from_batch_to_batch():
    keys, sizes = [None, None, 0, 0, 0, 7, 7, 8], [1, 2, 3, 4, 5, 6, 7, 8]
    for cut in range(9):
        runs, at, before = Runs(), [], []
        for a, b in ((0, cut), (cut, 8)):
            if b > a:
                found = runs.place(pa.array(keys[a:b], pa.int64()), np.array(sizes[a:b]))
                at += found[0].tolist()
                before += found[1].tolist()
        assert at == [0, 1, 0, 1, 2, 0, 1, 0]
        assert before == [0, 1, 0, 3, 7, 0, 6, 0]


# --- chat formatting

TRICKY = [
    "", "\\", "\\\\", "</turn>", "\\</turn>", "\\\\</turn>x", "<turn><says></turn>", "a\\", "</turn>\\", "<<turn>>",
    "\\### Assistant: </turn> ok", "\n\\\n", "<tur\\n>", "\x00<says>\x00", "日本 <says>", "<|endoftext|>",
]


def test_escaping_is_undone_and_leaves_no_mark_alone():
    rng = random.Random(1)
    parts = [*chat_format.MARKS, "\\", "\\", "x", "\n", "<", "é"]
    texts = TRICKY + ["".join(rng.choice(parts) for _ in range(rng.randint(0, 9))) for _ in range(2000)]
    escaped = chat_format.escape(pa.array(texts)).to_pylist()
    assert [chat_format.unescape(t) for t in escaped] == texts
    alone = re.compile(r"(?<!\\)(?:\\\\)*(?:<turn>|<says>|</turn>)")
    assert not [t for t in escaped if alone.search(t)]
    # Read as one text, the only marks that stand alone are those of the template.
    for a, b in zip(escaped, escaped[1:]):
        formatted = f"<turn>{a}<says>{b}</turn>"
        assert len(alone.findall(formatted)) == 3


def chats():
    rows = [(c, t, ("user", "assistant")[t % 2], text) for c, text in enumerate(TRICKY) for t in range(3)]
    rows += [(50, t, "assistant" if t % 3 else "user", f"turn {t} of very many") for t in range(400)]
    rows += [(60, None, None, None), (60, 1, "assistant", "b"), (60, 1, "assistant", "a"), (60, 1, "assistant", "a")]
    rows += [(None, 0, "user", "of no conversation"), (70, 0, "a</turn>\nb", "role"), (71, 0, "user", "long " * 30_000)]
    return rows


def test_formatted_conversations_are_read_back(make_chats):
    rows = chats()
    formatted = chat_format.format_conversations(make_chats(rows), TOKENIZER)
    talks = in_turn(rows)
    read = {(r.conv_id, r.at): r for r in chat_format.read_turns(formatted, TOKENIZER).collect()}
    assert {(c, i): (r, t) for c, turns in talks.items() for i, (r, t) in enumerate(turns)} == {
        k: (r.role, r.text) for k, r in read.items()
    }
    found = {r.conv_id: r for r in chat_format.read_digests(formatted, TOKENIZER).collect()}
    assert set(found) == set(talks)
    for c, turns in talks.items():
        loss = "".join(t for r, t in turns if r == "assistant")
        row = found[c]
        assert (row.n_turns, row.loss_chars) == (len(turns), len(loss))
        assert row.turns_sha256 == sha("".join(f"{r}\n{t}\n" for r, t in turns))
        assert row.loss_sha256 == sha(loss)
        shown = chat_format.escape(pa.array([s for turn in turns for s in turn])).to_pylist()
        assert row.formatted_chars == len("".join(shown)) + len(turns) * len("<turn><says></turn>")


def test_ids_are_those_of_the_segments_and_places_add_up(make_chats):
    rows = chats()
    library = Tokenizer.from_file(TOKENIZER)
    library.encode_special_tokens = True
    first = library.get_vocab_size()
    of_conv = defaultdict(dict)
    for r in chat_format.format_conversations(make_chats(rows), TOKENIZER, ["user"]).collect():
        of_conv[r.conv_id][r.at] = r

    def ids(text):
        return library.encode(chat_format.escape(pa.array([text]))[0].as_py(), add_special_tokens=False).ids

    for c, turns in in_turn(rows).items():
        start = 0
        for i, (role, text) in enumerate(turns):
            row, head = of_conv[c][i], [first, *ids(role), first + 1]
            assert np.frombuffer(row.ids, "<u4").tolist() == [*head, *ids(text), first + 2]
            assert (row.start, row.length) == (start, len(row.ids) // 4)
            assert row.loss_start == start + len(head)
            assert row.loss_length == (len(ids(text)) if role == "user" else 0)
            start += row.length


def test_conversations_cut_by_tasks_are_read_whole(spark, make_chats):
    rows = chats()
    formatted = chat_format.format_conversations(make_chats(rows), TOKENIZER)
    whole = sorted(map(repr, chat_format.read_digests(formatted, TOKENIZER).collect()))
    cut = chat_format.read_digests(formatted.repartition(5, "at"), TOKENIZER)
    assert sorted(map(repr, cut.collect())) == whole


# --- phrases


def phrases(rows, support, longest, top):
    """Phrases by counting all runs of words of all pieces."""
    counts, totals = defaultdict(Counter), Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        lower = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for i in range(len(words)):
                for k in range(1, min(longest, len(words) - i) + 1):
                    counts[lang][tuple(words[i : i + k])] += 1
    found = []
    for lang, of_lang in counts.items():
        several = {p: a for p, a in of_lang.items() if len(p) > 1 and a >= support}
        ranked = []
        for p, a in several.items():
            n = totals[lang]
            score, cut = min(
                (1000 * a * n // (of_lang[p[:k]] * of_lang[p[k:]]), k) for k in range(1, len(p))
            )
            longer = (
                q for q, b in several.items()
                if len(q) > len(p) and b >= a and any(q[i : i + len(p)] == p for i in range(len(q)))
            )
            if next(longer, None) is None:
                ranked.append((-score, -a, " ".join(p).encode(), of_lang[p[:cut]], of_lang[p[cut:]], n))
        for rank, (score, a, p, le, r, n) in enumerate(sorted(ranked)[:top], 1):
            found.append((lang, rank, p.decode(), -a, le, r, n, -score))
    return sorted(found)


def speeches(n=240, seed=9):
    rng = random.Random(seed)
    fixed = ["in the end of the day", "New York City", "ab ab ab ab", "of the"]
    vocabulary = [f"w{i}" for i in range(60)] + ["É", "日本", "x\x00y"]
    rows = []
    for i in range(n):
        parts = []
        for _ in range(rng.randint(0, 12)):
            parts.append(rng.choice(fixed) if rng.random() < 0.4 else " ".join(rng.choices(vocabulary, k=rng.randint(1, 6))))
            parts.append(rng.choice([" ", " ", "\t ", ". ", "\n", ",", "!? "]))
        rows.append((i, "".join(parts), rng.choice(["en", "en", "en", "de", "und", None])))
    return rows


@pytest.mark.parametrize("shard_words", [1, 300, 1 << 22])
def test_phrases_of_shards_of_any_size(spark, shard_words):
    rows = speeches() + [(7, None, "en"), (7, "", "fr"), (None, "NEW york city", "en")] * 2
    docs = spark.createDataFrame([(*r, 3, 4) for r in rows], "doc_id bigint, text string, lang string, n int, total int")
    found = collocations.collocations(docs.repartition(4), 12, 5, 9, shard_words)
    expected = phrases(rows, 12, 5, 9)
    assert sorted(tuple(r) for r in found.collect()) == expected
    assert len({r[0] for r in expected}) == 3


def test_a_full_filter_changes_nothing(spark, monkeypatch):
    rows = speeches(120, 10)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    monkeypatch.setattr(collocations, "MOST_BITS", collocations.LEAST_BITS)
    monkeypatch.setattr(collocations.Filter, "has", lambda self, digests: np.ones(len(digests), bool))
    found = collocations.frequent_phrases(docs, 10, 4, 100)[0]
    every = {(r.lang, r.phrase): r.f for r in found.collect()}
    monkeypatch.undo()
    found = collocations.frequent_phrases(docs, 10, 4, 100)[0]
    assert {(r.lang, r.phrase): r.f for r in found.collect()} == every and len(every) > 50


def test_a_round_gives_at_most_two_rows_a_word(spark, make_docs, monkeypatch):
    made, plain = [], collocations.arrow_map
    monkeypatch.setattr(collocations, "arrow_map", lambda *given: made.append(plain(*given)) or made[-1])
    words = [f"w{n}" for n in range(1200)]
    docs = make_docs([(n, " ".join([*words[30 * n : 30 * n + 30], "the same six words each time"])) for n in range(40)])
    phrases, totals = collocations.frequent_phrases(docs.repartition(20), 10, 5, 50)
    assert phrases.count() == 6 + 5 + 4 + 3 + 2 and totals.first().n == 1200 + 240
    assert max(df.count() for df in made) <= 2 * (1200 + 240)


def test_words_of_a_slice_are_those_of_its_texts():
    texts = [f"ÀÉ {'x' * i} Öß.ÇA É" for i in range(50)]
    flat, counts = collocations._tokens(pa.array(texts).slice(7, 3))
    assert [w for w in flat.to_pylist() if w] == [w for i in range(7, 10) for w in ["ÀÉ", "x" * i, "Öß", "\n", "Ça", "É", "\n"]]
    assert counts.sum() == len(flat)


def test_scores_are_exact_beyond_64_bits(spark):
    big = 3 * 10**15
    cuts = spark.createDataFrame([("x", big - 1, big, big - 1, 7 * 10**17 + 9)], "phrase string, a bigint, l bigint, r bigint, n bigint")
    assert collocations._scored(cuts).first().score == 1000 * (big - 1) * (7 * 10**17 + 9) // (big * (big - 1))


def test_phrases_of_odd_documents(spark, make_docs):
    found = collocations.collocations(make_docs(ODD), 2).collect()
    rows = [(i, t, lang) for i, t, lang, *_ in ((*row, None) for row in ODD)]
    assert sorted(tuple(r) for r in found) == phrases(rows, 2, 5, 2000)
    assert collocations.collocations(make_docs(ODD).where("doc_id > 99")).collect() == []
