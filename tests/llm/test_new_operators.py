"""SentencePiece encoding, source divergence and conversation repair against libraries and brute force."""

import random
import struct
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from loantide.llm import divergence, pieces, repair
from loantide.llm.queries import model_file

DOCS = "doc_id long, text string, lang string, source string"


@pytest.fixture(scope="module")
def library():
    sentencepiece = pytest.importorskip("sentencepiece")
    return sentencepiece.SentencePieceProcessor(model_file=model_file())


def odd_texts():
    random.seed(12)
    pool = ["the ", "  ", " " * 17, "▁", "Hello", "\n", "\t", "日本語", "😀", "é", "\x00", "\x85", "<s>", "<0x41>", "<unk>", "ing", "�", "x" * 60]
    texts = ["", " ", "  ", "▁", " a", "a "] + ["".join(random.choices(pool, k=random.randint(1, 30))) for _ in range(400)]
    letter = lambda: chr(random.choice([random.randint(0, 127), random.randint(0, 0xD7FF), random.randint(0x10000, 0x10FFFF)]))
    return texts + ["".join(letter() for _ in range(random.randint(1, 60))) for _ in range(300)]


def test_pieces_match_the_library(library):
    with open(model_file(), "rb") as file:
        encoder = pieces.Encoder(file.read(), check=False)
    texts = odd_texts()
    for text, ids in zip(texts, encoder.encode(texts)):
        assert list(struct.unpack(f"<{len(ids) // 4}i", ids)) == library.encode(text), text
        assert encoder.decode(ids) == library.decode(library.encode(text))
    line = "▁" + "".join(texts)[:300].replace(" ", "▁")
    assert encoder.pieces._merged(line) == encoder.pieces._merged_long(line)  # both agendas
    encoder.pieces.whole = True  # as for a vocabulary with pieces across words
    assert encoder.pieces.cuts("a  b▁c") == ["a  b  c".replace("  c", " c")]
    assert encoder.pieces.encode("the end  of it") == library.encode("the end  of it")
    for _ in range(500):  # ids that no text gives: bytes that are no characters, control and unknown pieces
        ids = random.choices([0, 1, 2, 3, 100, 130, 200, 195, 172, 5000, 264, 28705], k=random.randint(0, 9))
        assert encoder.pieces.decode(ids) == library.decode(ids), ids
    with pytest.raises((ValueError, KeyError)):
        pieces.Pieces(b"")


def test_pieces_cache_keeps_what_a_block_uses(library, monkeypatch):
    monkeypatch.setattr(pieces, "CACHE_ENTRIES", 5)
    with open(model_file(), "rb") as file:
        encoder = pieces.Encoder(file.read())
    for text in ["one two three", "two three four five", "six seven two", "one", "two " * 9, " ".join(map(str, range(30)))]:
        ids = encoder.encode([text])[0]
        assert list(struct.unpack(f"<{len(ids) // 4}i", ids)) == library.encode(text)


def test_pieces_frames(spark, library, monkeypatch):
    rows = [(1, "Hello world", "x"), (1, "Hello world", "x"), (None, None, "x"), (2, "", None), (3, "word  é " * 40_000, "x"), (4, "y" * 50_000, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    got = pieces.encode(df, ["doc_id"], "text", model_file(), decoded=True).collect()
    want = Counter((i, tuple(library.encode(t or "")), t or "") for i, t, _ in rows)
    assert Counter((r["doc_id"], tuple(r["ids"]), r["decoded"]) for r in got) == want
    again = pieces.decode(pieces.encode(df, ["doc_id"], "text", model_file()), ["doc_id"], model_file())
    assert Counter((r["doc_id"], tuple(r["ids"]), r["decoded"]) for r in again.collect()) == want
    assert pieces.decode(spark.createDataFrame([(1, None)], "k int, ids array<int>"), ["k"], model_file()).first()["decoded"] == ""
    assert pieces.encode(df.limit(0), ["doc_id"], "text", model_file()).count() == 0


def brute_audit(rows, documents=3, top=200):
    docs = [((lang or ""), (source or ""), [t.decode() for t in divergence.terms(text)]) for _, text, lang, source in rows]
    out = []
    for lang in {d[0] for d in docs}:
        seen = Counter(t for x, _, ts in docs if x == lang for t in set(ts))
        kept = [t for t, n in seen.items() if n >= documents]
        counts = {s: Counter() for x, s, _ in docs if x == lang}
        for x, s, ts in docs:
            if x == lang:
                counts[s].update(t for t in ts if seen[t] >= documents)
        whole = sum(counts.values(), Counter())
        share = lambda c, t: 1 + 10**9 * (c[t] + 1) // (sum(c.values()) + len(kept))
        price = lambda p, q: (p - q) * (p - q) // q
        for s, own in counts.items():
            pairs = [(o, sum(price(share(own, t), share(c, t)) for t in kept)) for o, c in counts.items() if o != s]
            told = [(t, price(share(own, t), share(whole, t))) for t in kept if own[t] and share(own, t) > share(whole, t)]
            for part, found, limit in (("pair", pairs, None), ("term", told, top)):
                found.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, item, value, k + 1) for k, (item, value) in enumerate(found[:limit])]
    return sorted(out)


def random_documents(n, words, sources):
    random.seed(13)
    vocabulary = [random.choice(["ab", "Éa", "éa", "Δ", "x", "日本", "q"]) + "bcdfg"[k % 5] * (k % 7) + "'"[: k % 2] + str(k) for k in range(words)]
    rows = [(k, " ".join(random.choices(vocabulary, k=random.randint(0, 40))), random.choice(["en", "de", None]), random.choice(sources)) for k in range(n)]
    return rows + [(0, None, "en", None), (0, "only here", "xx", "s1"), (0, "only here", "xx", "s2"), rows[0], rows[0], (None, "ab " * 3_000, "de", "s1")]


def test_audit_matches_brute_force(spark, monkeypatch):
    rows = random_documents(150, 60, ["s1", "s2", "s10", "", None, "é"])
    df = spark.createDataFrame([(*r, "taken") for r in rows], f"{DOCS}, value string").repartition(5)
    want = brute_audit(rows)
    assert {r[0] for r in want} >= {"", "en", "de", "xx"} and len([r for r in want if r[0] == "xx"]) == 2
    assert sorted(tuple(r) for r in divergence.audit(df).collect()) == want
    # Many blocks, many chunks, few terms told.
    for name, value in {"BLOCK": 4, "CHUNK": 2}.items():
        monkeypatch.setattr(divergence, name, value)
    assert sorted(tuple(r) for r in divergence.audit(df, top=2).collect()) == brute_audit(rows, top=2)
    assert divergence.audit(df.limit(0)).count() == 0


def test_equal_pairs_of_nodes_are_priced_once():
    """A thousand terms counted in three ways: the walk ends in three pairs of leaves, whose times add up."""
    counts = np.repeat(np.array([[0, 1, 5], [0, 0, 7]]), [700, 300, 24], axis=1)
    trees = divergence.Trees(counts)
    pair, a, b, times = trees.walk(np.array([0]), np.array([1]))
    met = {(int(trees.counts[x]), int(trees.counts[y])): int(t) for x, y, t in zip(a, b, times) if x != trees.empty}
    assert met == {(0, 0): 700, (1, 0): 300, (5, 7): 24} and set(pair) == {0}
    assert sum(len(c) for c in trees.children) < 60  # shared nodes, where two trees of their own would have 2,046
    same = divergence.Trees(np.tile(counts[:1], (50, 1)))
    assert len(set(same.roots.tolist())) == 1


def test_small_steps_and_flushes_change_nothing(monkeypatch):
    rng = np.random.default_rng(13)
    counts = rng.poisson(0.3, (7, 37)) * rng.integers(1, 4, (7, 37))
    sizes = [(int(c.sum()), 37) for c in counts]
    left, right = np.triu_indices(7, 1)
    there, back = divergence.divergences(counts, sizes, left, right)
    p = [divergence.shares(c, *s) for c, s in zip(counts, sizes)]
    assert there.tolist() == [int(divergence.prices(p[i], p[j]).sum()) for i, j in zip(left, right)]
    assert back.tolist() == [int(divergence.prices(p[j], p[i]).sum()) for i, j in zip(left, right)]
    batch = pa.RecordBatch.from_pydict({"lang": ["en"] * 30, "source": ["s"] * 30, "text": [f"a b{chr(97 + k % 26)} a" for k in range(30)]})
    whole = pa.Table.from_batches(divergence._counted([batch]))
    monkeypatch.setattr(divergence, "PAIRS", 8)
    monkeypatch.setattr(divergence, "HELD", 5)
    assert all((x == y).all() for x, y in zip(divergence.divergences(counts, sizes, left, right), (there, back)))
    parts = pa.Table.from_batches(divergence._counted([batch])).group_by("term").aggregate([("count", "sum"), ("docs", "sum")])
    key = lambda t: sorted(map(tuple, (r.values() for r in t.to_pylist())))
    assert key(parts.select(["term", "count_sum", "docs_sum"])) == key(whole.select(["term", "count", "docs"]))


def test_shares_are_exact_beyond_long():
    assert divergence.shares(np.array([10**17]), 3 * 10**17, 7).tolist() == [1 + 10**9 * (10**17 + 1) // (3 * 10**17 + 7)]


def brute_repair(codes, entry=repair.START, goals=repair.ENDS):
    """The least (cost, audit) over all edits, each position of each kind tried."""
    follows = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}
    best = None

    def go(at, state, cost, audit, inserted):
        nonlocal best
        if best and cost > best[0]:
            return
        if at == len(codes) and state in goals and (best is None or (cost, audit) < best[:2]):
            best = (cost, audit, state)
        for kind in "ua":
            if inserted < 4 and kind in follows[state]:
                go(at, follows[state][kind], cost + 2, audit + "I", inserted + 1)
        if at < len(codes):
            go(at + 1, state, cost + 3, audit + "D", 0)
            if codes[at] != "-":
                late = codes[at].isupper()
                if codes[at].lower() in follows[state]:
                    go(at + 1, follows[state][codes[at].lower()], cost + late, audit + "K", 0)
                for kind in "ua":
                    if kind in follows[state]:
                        go(at + 1, follows[state][kind], cost + 2 + late, audit + "R", 0)

    go(0, entry, 0, "", 0)
    return best


def test_search_matches_brute_force():
    random.seed(11)
    every = ["".join(random.choices("-suaxSUAX", k=random.randint(0, 4))) for _ in range(120)] + ["", "s", "-", "ss", "uu", "aa", "us", "SuA"]
    for codes in every:
        assert repair.search(codes, repair.START) == brute_repair(codes), codes
        for entry, goal, cost, audit in repair.ways_through(codes, whole=False):
            assert (cost, audit, goal) == brute_repair(codes, entry, (goal,)), (codes, entry, goal)
    assert {w[:2] for w in repair.ways_through("u", False)} == {(0, 0), (0, 2), (0, 3), (1, 1), (1, 2), (1, 3), (2, 2), (2, 3), (3, 2), (3, 3)}
    long = "".join(random.choices("-suaxSUAX", k=20_000))  # time and stack stay linear in the turns
    assert repair.search(long, repair.START)[1].count("D") >= long.count("-")


def plain_repair(rows):
    """By conversation: faults, gaps, edits and repaired turns, from all its rows at once."""
    out, by_conv = {}, defaultdict(list)
    for conv, turn, role, text in rows:
        by_conv[conv].append((turn is not None, turn or 0, turn, " " if role is None else role, " " if text is None else text))
    for conv, own in by_conv.items():
        own.sort(key=lambda r: (*r[:2], r[3].encode(), r[4].encode()))
        turns = {r[2] for r in own} - {None}
        faults, seen, codes = Counter(), set(), ""
        for r in own:
            solid = r[4].strip(" \t\n\x0b\x0c\r")
            fault = "blank" if not solid else "duplicate" if r[3:] in seen else "truncated" if solid[-1] not in ".!?" else None
            seen.add(r[3:])
            faults[fault] += 1
            kind = r[3][:1] if r[3][:1] in ("s", "u", "a") else "x"
            codes += "-" if fault in ("blank", "duplicate") else kind.upper() if fault else kind
        illegal = sum(a[3][:1] + b[3][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:]))
        cost, audit, _ = repair.search(codes, repair.START)
        lines = []
        for edit, at, role in repair.edits_of(codes, repair.START, audit):
            if edit != "D":
                lines.append(f"{role or own[at][3]}:{own[at][4] if at is not None else ''}")
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        out[conv] = (gaps, faults["blank"], faults["duplicate"], faults["truncated"], illegal, cost, audit, lines)
    return out


def conversations(n):
    random.seed(111)
    texts = ["Yes.", "yes", "", " \n", "No! ", "a? b", "é.", "…", None, "x" * 5_000 + "."]
    roles = ["user", "assistant", "system", "tool", "", None, "User", "ä"]
    rows = []
    for conv in range(n):
        for turn in range(random.randint(1, 9)):
            if random.random() < 0.9:
                role = random.choice(roles) if random.random() < 0.3 else ("user", "assistant")[turn % 2]
                rows.append((conv if conv % 11 else None, turn if random.random() < 0.9 else None, role, f"{turn}." if random.random() < 0.6 else random.choice(texts)))
    rows += [r for r in rows if random.random() < 0.1]
    return rows


def test_repair_of_frames(spark):
    rows = conversations(60)
    rows += [(1_000, k, ("user", "assistant")[k % 2], f"{k}.") for k in range(700)]  # longer than a block
    rows += [(1_001, 5, "user", "the same.")] * 600
    df = spark.createDataFrame([(*r, "taken") for r in rows], "conv_id long, turn long, role string, text string, key string").repartition(4)
    want = plain_repair(rows)
    for size in (repair.BLOCK, 4):
        found = repair.repair(df, size=size)
        got = {r["key"]: r for r in found.conversations.collect()}
        lines = defaultdict(list)
        for r in found.turns.filter("edit <> 'D'").orderBy("key", "block", "seq").collect():
            lines[r["key"]].append(f"{r['role']}:{r['text']}")
        assert len(got) == len(want)
        for conv, (*sums, audit, repaired) in want.items():
            key = "" if conv is None else f"={conv}"
            row = got[key]
            assert [row[c] for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")] == sums, (conv, size)
            assert row["audit"] == audit and lines[key] == repaired, (conv, size)
    none = repair.repair(df.limit(0))
    assert none.conversations.count() == 0 and none.turns.count() == 0


def test_blocks_know_when_they_are_whole():
    keys = ["a"] * 3 + ["b"] * 2 + ["c"] * 9 + ["d"] * 4 + ["e"]
    for step in (1, 2, 5, 100):
        batches = [pa.RecordBatch.from_pydict({"key": keys[k:k + step]}) for k in range(0, len(keys), step)]
        got = [(b.column("key").to_pylist(), b.column("alone")[0].as_py()) for b in repair._blocks(iter(batches), 3, 4)]
        assert got == [(["a"] * 3, False), (["b"] * 2, True), (["c"] * 4, False), (["c"] * 4, False), (["c"], False), (["d"] * 4, True), (["e"], False)]
