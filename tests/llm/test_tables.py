"""Source divergence, prefix trie and packing against plain versions."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tests.llm.brute import UPPER
from tests.llm.test_operators import odd_rows, prose
from tidemark.llm import best_fit, prefix_trie, source_divergence
from tidemark.llm.shipping import ship

BYTES = public_tokenizers.path("byte_bpe_50k.json")


def divergence(rows, least, top=50):
    """Plain version over (lang, source, text)."""
    counts, docs, groups = defaultdict(Counter), defaultdict(Counter), set()
    for lang, source, text in rows:
        lang, source = lang or "", source or ""
        found = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(UPPER))
        groups.add((lang, source))
        counts[lang, source].update(found)
        counts[lang, None].update(found)
        docs[lang].update(set(found))
    kept = {g[0]: sorted(t for t, n in docs[g[0]].items() if n >= least) for g in groups}

    def share(lang, source):
        own, terms = counts[lang, source], kept[lang]
        whole = sum(own[t] for t in terms) + 5 * len(terms)
        return {t: 1 + 10**9 * (own[t] + 5) // whole for t in terms}

    out = []
    for lang, source in groups:
        p, q = share(lang, source), share(lang, None)
        pairs = []
        for other in sorted(s for a, s in groups if a == lang and s != source):
            r = share(lang, other)
            pairs.append((-sum(abs(p[t] - r[t]) for t in p), other.encode()))
        terms = [(q[t] - p[t], t.encode()) for t in p if counts[lang, source][t] and p[t] > q[t]]
        for part, found in (("pair", sorted(pairs)), ("term", sorted(terms)[:top])):
            out += [(lang, source, part, i.decode(), -v, k) for k, (v, i) in enumerate(found, start=1)]
    return out


def odd_sources():
    draw = random.Random(5)
    rows = [
        (draw.choice(["en", "de", None]), draw.choice(["a", "b", "b", None, "Ä", "c"]), t)
        for _, t in odd_rows()
    ]
    rows += [("en", draw.choice("ab"), prose(i % 7, 40)) for i in range(60)]
    return rows + [("xx", "only", None), ("xx", "other", "12 34"), (None, None, None), ("de", "z", "")]


@pytest.mark.parametrize("least, entries", [(3, 400_000), (3, 50), (1, 7), (1000, 400_000)])
def test_source_divergence(spark, least, entries):
    ship(spark)
    rows = odd_sources()
    frame = spark.createDataFrame(rows, "lang string, source string, text string").repartition(5)
    clashing = ("term", "docs", "sources", "counts", "shape", "block", "shard", "value", "item", "n")
    frame = frame.withColumns({c: F.lit("x") for c in clashing})
    got = source_divergence.source_divergence(frame, least_documents=least, entries=entries)
    assert sorted(map(tuple, got.collect())) == sorted(divergence(rows, least))


def test_source_divergence_splits_wide_languages(spark, monkeypatch):
    """More pairs of sources than a task may hold are dealt to several."""
    ship(spark)
    monkeypatch.setattr(source_divergence, "CELLS", 9)
    rows = odd_sources()
    frame = spark.createDataFrame(rows, "lang string, source string, text string")
    got = source_divergence.source_divergence(frame, least_documents=2)
    assert sorted(map(tuple, got.collect())) == sorted(divergence(rows, 2))


def test_source_divergence_of_nothing_and_of_long_texts(spark, monkeypatch):
    frame = spark.createDataFrame([], "lang string, source string, text string")
    assert source_divergence.source_divergence(frame).count() == 0
    text = prose(9, 3000).encode()
    assert source_divergence._terms(text) == Counter(text.split())
    monkeypatch.setattr(source_divergence, "LISTED", 10)
    assert source_divergence._terms(text) == Counter(text.split())


def test_shares_are_exact():
    draw = random.Random(2)
    for _ in range(300):
        whole = draw.randint(1, 9 * 10**15)
        count = draw.randint(1, whole)
        assert source_divergence.shares(np.array([count]), whole)[0] == 10**9 * count // whole


def trie(rows):
    """Plain version over (conv_id, turn, role, text)."""
    turns = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            both = f"{len(role.encode())}:{role}{text}".encode()
            order = (turn is not None, turn or 0, hashlib.sha256(both).digest()[:16])
            turns[c].append((order, (role, text)))
    turns = {c: [t for _, t in sorted(x, key=lambda x: x[0])] for c, x in turns.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (abs(c) % 20) * (1 if c >= 0 else -1)
        path = tuple(turns.get(base, [])[:h] + own[h:])
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
        ends[path].append(c)
    children = Counter(p[:-1] for p in members if p)
    leaves, saved = Counter(), Counter()
    for p, own in members.items():
        words = len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
        for d in range(len(p) + 1):
            leaves[p[:d]] += p not in children
            saved[p[:d]] += (len(own) - 1) * words
    out = []
    for p, own in members.items():
        line = ",".join(map(str, sorted(ends.get(p, ()))))
        parent = min(members[p[:-1]]) if p else None
        digest = hashlib.sha256(line.encode()).hexdigest()
        out.append((min(own), len(p), parent, len(own), children[p], leaves[p], saved[p], digest))
    return out


def odd_turns():
    draw = random.Random(11)
    rows = []
    for c in [*range(-45, 130), 10**12, 10**12 + 1]:
        length = draw.choice([0, 1, 1, 2, 3, 4, 6, 9])
        rows += [
            (c, t, draw.choice(["user", "assistant"]), draw.choice(["hello there", "yes", "no", None, f"{c} a b"]))
            for t in range(length)
        ]
    rows += [(200 + c, t, "user", f"turn {t}") for c in range(40) for t in range(5 + c % 3)]
    rows += [(300, t, "user", f"deep {t} x") for t in range(400)]
    rows += [(340, t, "user", f"deep {t} x" if t != 250 else "else") for t in range(400)]
    rows += [(400, None, None, "first"), (400, 1, "user", "b"), (400, 1, "user", "b"), (400, 1, "user", "a")]
    return rows + [(None, 0, "user", "nobody"), (401, 0, None, None)]


def ordered(rows):
    return sorted(map(tuple, rows), key=str)


@pytest.mark.parametrize("block, fan", [(prefix_trie.BLOCK, 64), (600, 2)])
def test_prefix_trie(spark, block, fan):
    ship(spark)
    rows = odd_turns()
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)
    frame = frame.withColumns({c: F.lit("x") for c in ("at", "id", "words", "key", "path", "n", "part", "of")})
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    try:
        got = prefix_trie.prefix_trie(frame, block=block, fan=fan)
        assert ordered(got.collect()) == ordered(trie(rows))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "2")


def test_prefix_trie_of_nothing(spark):
    kind = "conv_id long, turn long, role string, text string"
    assert prefix_trie.prefix_trie(spark.createDataFrame([], kind)).count() == 0
    # A conversation that keeps no turn of its own is a member of the root alone.
    turnless = next(c for c in range(21, 40) if zlib.crc32(str(c).encode()) % 4 > 0)
    rows = [(turnless, 0, "user", "x")]
    assert ordered(prefix_trie.prefix_trie(spark.createDataFrame(rows, kind)).collect()) == ordered(trie(rows))


def test_radix_nodes_grow_through_their_layouts():
    root = prefix_trie.Node(b"")
    seen = []
    for byte in random.Random(1).sample(range(256), 256):
        prefix_trie.insert(root, prefix_trie.Leaf(bytes([byte]) * 16, [1], byte, 1, ""))
        seen.append(root.layout)
    assert [seen.count(k) for k in (4, 16, 48, 256)] == [4, 12, 32, 208]
    assert [b for b, _ in root.children()] == list(range(256))
    assert all(root.child(b).run == bytes([b]) * 15 for b in range(256))
    # A run is split where a key leaves it, and a key may end inside another.
    prefix_trie.insert(root, prefix_trie.Leaf(b"\7" * 32, [1, 1], 300, 1, ""))
    prefix_trie.insert(root, prefix_trie.Leaf(b"\7" * 20 + b"\10" * 12, [1, 1], 301, 1, ""))
    node = root.child(7)
    assert node.leaf.conv_id == 7 and node.size == 1
    assert node.child(7).run == b"\7" * 3 and node.child(7).size == 2


def test_reduction_keeps_an_optimum():
    """Fixed sets are part of a smallest packing, by trying all packings of small instances."""

    def least(items, limit):
        best = len(items)

        def go(i, rooms):
            nonlocal best
            if len(rooms) >= best:
                return
            if i == len(items):
                best = len(rooms)
                return
            for k in {room: k for k, room in enumerate(rooms) if room >= items[i]}.values():
                go(i + 1, [r - items[i] if j == k else r for j, r in enumerate(rooms)])
            go(i + 1, [*rooms, limit - items[i]])

        go(0, [])
        return best

    draw = random.Random(4)
    shrunk = 0
    for _ in range(400):
        limit = draw.choice([9, 10, 16, 25])
        items = sorted((draw.randint(1, limit) for _ in range(draw.randint(1, 9))), reverse=True)
        lengths = best_fit._Lengths(Counter(items))
        fixed = sum(times for _, times in best_fit.reduced(lengths, limit))
        rest = sorted((n for n, c in lengths.counts.items() for _ in range(c)), reverse=True)
        assert fixed + least(rest, limit) == least(items, limit), items
        shrunk += fixed
        assert best_fit.plan(Counter(items), limit).sequences <= least(items, limit) + 1
    assert shrunk > 400
    with pytest.raises(ValueError):
        best_fit.plan({11: 1}, 10)


def packed_well(rows, docs, limit):
    """Checks the pieces of ``packed`` against the library and counts the sequences."""
    tokenizer = Tokenizer.from_file(BYTES)
    expected = Counter()
    for i, text in docs:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        first = (len(ids) - 1) % limit + 1
        cuts = [0, *range(first, len(ids) + 1, limit)]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
            expected[i, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())] += 1
    assert Counter(tuple(r[:5]) for r in rows) == expected
    sequences = defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for own in sequences.values():
        at = 0
        for offset, n in sorted(own):
            assert offset == at
            at += n
        assert at <= limit
    return len(sequences)


@pytest.mark.parametrize("limit", [2048, 64])
def test_packed(spark, limit):
    ship(spark)
    docs = odd_rows() + [(50 + i, prose(i, 5 + i % 9)) for i in range(200)]
    docs += [(None, "a\r\nb  c"), (None, "\n x\n\ny "), (7, "x " * 50)]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    frame = frame.withColumns({c: F.lit("x") for c in ("piece", "n", "nth", "part", "l", "p", "at", "first", "e")})
    got = best_fit.packed(frame, BYTES, limit=limit, ids=True)
    rows = got.collect()
    for r in rows:
        assert zlib.crc32(r["ids"]) == r["ids_crc32"] and len(r["ids"]) == 4 * r["length"]
    least = -(-sum(r["length"] for r in rows) // limit)
    assert packed_well(rows, docs, limit) <= least + 1
    assert best_fit.packed(frame.limit(0), BYTES).count() == 0


def test_blocks_of_long_texts_encode_alike(monkeypatch):
    monkeypatch.setattr(best_fit, "BLOCK", 40)
    own, tokenizer = best_fit.ChunkIds(BYTES), Tokenizer.from_file(BYTES)
    for text in [prose(1, 200), "a  b " * 40, " \n".join(["x y"] * 40), "<|endoftext|> it's " * 30, "\t" * 90 + " x"]:
        assert own.ids(text) == np.array(tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
