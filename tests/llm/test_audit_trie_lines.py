"""Divergence audit, prefix trie and line deduplication against plain Python, and their defined results for odd rows."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from tests.conftest import SF001
from valuepay.llm import divergence, line_repeats, turn_trie

SCHEMA = "doc_id long, text string, lang string, source string, term string, peer int, value long, h long, key string, tx long, row string, drop int, `odd name` string"


def frame(spark, rows):
    """``(doc_id, text, lang, source)`` with extra columns whose names clash with those inside the operators."""
    return spark.createDataFrame([(*r, "x", 1, 2, 3, "x", 4, "x", 5, "x") for r in rows], SCHEMA)


# ------------------------------------------------------------------ 11: divergence audit
def audited(rows, min_docs, top):
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    docs = [(l or "", s or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (t or "").translate(low))) for _, t, l, s in rows]
    out = set()
    for lang in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == lang]
        df = Counter(w for d in own for w in set(d[2]))
        kept = sorted(w for w in df if df[w] >= min_docs)
        v = len(kept)

        def shares(part):
            count = Counter(w for d in part for w in d[2] if df[w] >= min_docs)
            n = sum(count.values())
            return count, {w: 1 + 10 ** 9 * (count[w] + 2) // (n + 2 * v) for w in kept}

        q = shares(own)[1]
        by = {s: shares([d for d in own if d[1] == s]) for s in {d[1] for d in own}}
        for s, (count, p) in by.items():
            pairs = [(o, sum((p[w] - by[o][1][w]) ** 2 // (p[w] + by[o][1][w]) for w in kept)) for o in by if o != s]
            terms = [(w, (p[w] - q[w]) ** 2 // (p[w] + q[w])) for w in kept if count[w] and p[w] > q[w]]
            for part, found, most in (("pair", pairs, None), ("term", terms, top)):
                ranked = sorted(found, key=lambda x: (-x[1], x[0].encode()))[:most]
                out |= {(lang, s, part, item, value, k + 1) for k, (item, value) in enumerate(ranked)}
    return out


@pytest.fixture(scope="module")
def prose():
    rng = random.Random(5)
    words = ["alpha", "Beta", "gamma", "déjà", "日本", "x", "zeta", "Übung", "omega", "rare"]
    rows = [(i, " ".join(rng.choices(words, weights=[9, 8, 7, 6, 5, 4, 3, 2, 2, 1], k=rng.randint(0, 30))) + rng.choice(["", ".\n", "\x00,1"]),
             rng.choice(["en", "de", None]), rng.choice(["a", "b", "c", "d", None])) for i in range(120)]
    # a source without terms, a language without kept terms, one with a single source, a hot and long text, repeats
    rows += [(200, "123 --", "en", "none"), (201, "seldom", "fr", "a"), (202, None, "fr", "b"), (203, "solo " * 3, "it", "a")]
    rows += [(300, "alpha Hot " * 4000, "en", "hot")] * 4 + [(None, "gamma", None, None), (None, None, None, None)]
    return rows


@pytest.mark.parametrize("min_docs,top,shard", [(3, 2, 250_000), (1, 10, 3), (10, 10, 7)])
def test_audit_equals_plain_python(spark, prose, monkeypatch, min_docs, top, shard):
    monkeypatch.setattr(divergence, "SHARD_ROWS", shard)
    found = divergence.audit(frame(spark, prose), min_docs, top).collect()
    assert len(found) == len({tuple(r) for r in found})
    assert {tuple(r) for r in found} == audited(prose, min_docs, top)


def test_audit_of_documents_equals_plain_python(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text", "lang", "source").collect()]
    assert {tuple(r) for r in divergence.audit(docs).collect()} == audited(rows, 10, 10)


def test_audit_of_nothing(spark):
    assert divergence.audit(frame(spark, [])).collect() == []
    one = divergence.audit(frame(spark, [(1, None, None, None)])).collect()
    assert one == []
    two = divergence.audit(frame(spark, [(1, None, None, None), (2, "a", None, "s")])).collect()
    assert {tuple(r) for r in two} == {("", "", "pair", "s", 0, 1), ("", "s", "pair", "", 0, 1)}


def test_shares_are_exact_for_large_counts(spark):
    big = 4 * 10 ** 18
    got = spark.createDataFrame([(big - 1, big, 3)], "c long, n long, v long").select(divergence.share("c", "n", "v").alias("p")).first()["p"]
    assert got == 1 + 10 ** 9 * (big + 1) // (big + 6)


# ------------------------------------------------------------------ 12: prefix trie
def trie(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            tie = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()[:32]
            own[c].append(((turn is not None, turn or 0, role, tie), role, text))
    own = {c: [x[1:] for x in sorted(v)] for c, v in own.items()}
    made = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (abs(c) % 20) * (1 if c >= 0 else -1)
        made[c] = tuple(own.get(base, [])[:h] + own[c][h:])
    members = defaultdict(list)
    for c, path in made.items():
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
    kids = Counter(p[:-1] for p in members if p)
    saved, leaves = Counter(), Counter()
    for p, m in members.items():
        words = len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
        for d in range(len(p) + 1):
            saved[p[:d]] += (len(m) - 1) * words
            leaves[p[:d]] += not kids[p]
    return sorted((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), kids[p], leaves[p], saved[p],
                   hashlib.sha256(",".join(str(c) for c in sorted(m) if made[c] == p).encode()).hexdigest()) for p, m in members.items())


def turns(spark, rows):
    return spark.createDataFrame([(*r, b"x", 1, "x", 2, "x") for r in rows],
                                 "conv_id long, turn long, role string, text string, path binary, shard int, words string, h int, part string")


def nodes(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: (r[0], r[1], r[2] is not None, r[2] or 0, *r[3:]))


@pytest.fixture(scope="module")
def talks():
    rng = random.Random(3)
    rows = []
    for c in range(-25, 130):
        for t in range(rng.choice([1, 1, 2, 3, 4, 6])):
            rows.append((c, t, rng.choice(["user", "assistant"]), rng.choice(["hello there", "yes", " a  b\tc", "", "näïve 日本"])))
    rows += [(140, t, "user", f"w{t}") for t in range(300)]  # a long one
    rows += [(c, 0, "user", "the same opening words") for c in range(200, 300)]  # copies over several blocks
    rows += [(301, None, None, None), (301, 1, None, "x"), (301, 1, "b", "x"), (301, 1, "a", "y"), (301, 2, "a", "y"), (301, 2, "a", "y")]
    rows += [(None, 0, "user", "nobody"), (None, None, None, None), (10 ** 15 + 7, -3, "user", "far"), (10 ** 15 + 7, 5, "user", "away")]
    return rows


@pytest.mark.parametrize("shard_turns,split_turns", [(200_000, 256), (40, 256), (5, 256), (5, 1), (1, 3)])
def test_trie_equals_plain_python(spark, talks, shard_turns, split_turns):
    found = turn_trie.prefix_trie(turn_trie.rebuilt(turns(spark, talks)), shard_turns, split_turns)
    assert nodes(found) == sorted(trie(talks), key=lambda r: (r[0], r[1], r[2] is not None, r[2] or 0, *r[3:]))


def test_trie_of_copies_cut_by_many_bounds(spark, monkeypatch):
    """One group of equal conversations over several shards: its ids come in order all the same."""
    monkeypatch.setattr(turn_trie, "CHUNK", 3)
    digest = hashlib.sha256(b"a").digest()[:16]
    rows = [(c, [(digest, 2), (digest, 3)]) for c in range(-40, 60)] + [(100, [(digest, 2)]), (101, [])]
    df = spark.createDataFrame(rows, "conv_id long, turns array<struct<digest: binary, words: int>>")
    found = {r["depth"]: r for r in turn_trie.prefix_trie(df, 10).collect()}
    ids = ",".join(str(c) for c in range(-40, 60))
    assert found[2]["ends_sha256"] == hashlib.sha256(ids.encode()).hexdigest()
    assert (found[2]["n_convs"], found[1]["n_convs"], found[0]["n_convs"]) == (100, 101, 102)
    assert (found[0]["saved_tokens"], found[0]["n_leaves"], found[1]["n_children"]) == (99 * 3 + 100 * 2, 1, 1)
    assert found[0]["ends_sha256"] == hashlib.sha256(b"101").hexdigest()


def test_trie_of_nothing(spark):
    assert turn_trie.prefix_trie(turn_trie.rebuilt(turns(spark, []))).collect() == []
    assert turn_trie.prefix_trie(turn_trie.rebuilt(turns(spark, [(None, 1, "a", "b")]))).collect() == []


# ------------------------------------------------------------------ 13: line deduplication
BLANK = " \t\n\x0b\f\r"


def line_key(line):
    return line.strip(BLANK).translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))


def cut(rows, min_docs, min_chars):
    held = Counter(k for r in rows for k in {line_key(x) for x in (r[1] or "").split("\n")} if len(k) >= min_chars)
    out = []
    for r in rows:
        lines = (r[1] or "").split("\n")
        kept = [x for x in lines if held[line_key(x)] < min_docs]
        out.append((r[0], len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(8)
    pool = ["Menu", " menu\t", "MENU", "Copyright 日本", "", " ", "ß line", "é", "a\x00b", "one  two"] + [f"line {k}" for k in range(60)]
    rows = [(i, "\n".join(rng.choices(pool, k=rng.randint(0, 9))), "en", "s") for i in range(80)]
    rows += [(100, None, None, None), (101, "", None, None), (102, "\n\n", None, None), (103, "x" * 200_000 + "\nmenu", None, None)]
    rows += [(104, "\n".join(f"own {k}" for k in range(3000)) + "\nMenu", None, None), (None, "Menu\nline 1", None, None), (None, "own\nmenu", None, None)]
    rows += [(200, "again\nand again", None, None)] * 4 + [(200, "again\nother", None, None)]  # repeated rows, an id with two texts
    return rows


def order(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, *r[1:]))


@pytest.mark.parametrize("limits", [{}, {"limit": 0}, {"limit": 0, "few": 0}])
@pytest.mark.parametrize("min_docs,min_chars", [(10, 1), (3, 0), (5, 2)])
def test_lines_equal_plain_python(spark, texts, min_docs, min_chars, limits):
    found = line_repeats.digests(frame(spark, texts).repartition(5), min_docs, min_chars, **limits).collect()
    want = [(i, n, d, hashlib.sha256(t.encode()).hexdigest()) for i, n, d, t in cut(texts, min_docs, min_chars)]
    assert order(tuple(r) for r in found) == order(want)


def test_first_occurrence_stays(spark):
    rows = [(5, "Head\nfive\nhead", None, None), (2, "two\n HEAD \nhead", None, None), (None, "head\nnone", None, None), (9, "nine", None, None), (8, None, None, None)]
    df = frame(spark, rows)
    found = line_repeats.without_repeated_lines(df, min_docs=3, min_chars=1, keep="first")
    assert found.columns == df.columns
    assert {r["doc_id"]: r["text"] for r in found.collect()} == {5: "five", 2: "two\n HEAD ", None: "none", 9: "nine", 8: None}
    assert {(r["odd name"], r["tx"], r["row"]) for r in found.collect()} == {("x", 4, "x")}
    none = line_repeats.without_repeated_lines(df, min_docs=3, keep="none")
    assert {r["doc_id"]: r["text"] for r in none.collect()} == {5: "five", 2: "two", None: "none", 9: "nine", 8: None}
    with pytest.raises(ValueError):
        line_repeats.line_drops(df, keep="last")


def test_lines_of_nothing(spark):
    assert line_repeats.digests(frame(spark, [])).collect() == []
    assert line_repeats.without_repeated_lines(frame(spark, [])).collect() == []


def test_full_once_seen_filter_only_suspects_more(spark, texts, monkeypatch):
    monkeypatch.setattr(line_repeats, "BITS_A_KEY", 0)
    monkeypatch.setattr(line_repeats, "PAGE", 32768)
    found = line_repeats.digests(frame(spark, texts * 2), 10, 1).collect()
    want = [(i, n, d, hashlib.sha256(t.encode()).hexdigest()) for i, n, d, t in cut(texts * 2, 10, 1)]
    assert order(tuple(r) for r in found) == order(want)
