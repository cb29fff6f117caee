"""Operators over texts against the libraries or brute force, and their defined results for odd rows."""

import base64
import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
import regex
import sentencepiece
import tiktoken
import xxhash
from tokenizers import Tokenizer

from tests.conftest import SF001
from valuepay.llm import bpe, content_sort, language, licences, packing, pieces, simhash, slots, substrings

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, "
          "k string, t long, h string, tx long, bits string, ids long, size string, norm string, row string, kept string")


def frame(spark, rows):
    """Documents with extra columns whose names clash with those inside the operators."""
    return spark.createDataFrame([(i, t, l, None, None if t is None else len(t), *["x", 1, "x", 1, "x", 1, "x", "x", "x", "x"])
                                  for i, t, l in rows], SCHEMA)


def prose(seed, n=120):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice(["an", "er", "the", "on", "ti", "ou", "st"]) for _ in range(rng.randint(1, 4))) for _ in range(n))


ODD = ["", " ", "\n\t ", "  two  spaces ", "it's we'll <|endoftext|> don't", "日本語 テキスト ①²½", "é naïve 🙂🙂 🙂", "a" * 5000,
       "</s> <s> <unk> <0x41> ▁ a▁b", "\x1c\x1d a\x00b", "word", "12345 67,89", "MIT License. apache LICENSE\nGNU General Public License"]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, None) for i, t in enumerate(ODD)] + [(100 + i, prose(i), "en") for i in range(6)]
    rows += [(200, None, "en"), (None, "no id", None), (None, None, None), (100, prose(0), "en"), (201, prose(0) * 40, "en")]
    return frame(spark, rows)


@pytest.fixture(scope="module")
def real(spark):
    return spark.read.parquet(f"{SF001}/documents.parquet")


def by_id(df):
    return {r["doc_id"]: r for r in df.collect() if r["doc_id"] is not None}


def texts_of(df):
    return {r["doc_id"]: r["text"] for r in df.select("doc_id", "text").collect() if r["doc_id"] is not None}


def empty(spark):
    return frame(spark, [])


@pytest.mark.parametrize("table", ["docs", "real"])
def test_byte_bpe_equals_the_library(table, request):
    df = request.getfixturevalue(table)
    path = P.path("byte_bpe_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    ids = by_id(bpe.encode(df, path, P.PATTERN))
    digests = by_id(bpe.round_trip_digests(df, path, P.PATTERN))
    for i, text in texts_of(df).items():
        want = library.encode_ordinary(text or "")
        assert ids[i]["ids"] == want, i
        assert digests[i]["n_tokens"] == len(want)
        assert digests[i]["ids_sha256"] == hashlib.sha256(" ".join(map(str, want)).encode()).hexdigest()
        assert digests[i]["decoded_sha256"] == hashlib.sha256((text or "").encode()).hexdigest()
    assert bpe.round_trip_digests(df, path, P.PATTERN).count() == df.count()


def test_byte_bpe_decodes_to_the_text(spark, docs):
    path = P.path("byte_bpe_50k.tiktoken")
    back = by_id(bpe.decode(bpe.encode(docs, path, P.PATTERN), path))
    assert all(bytes(back[i]["decoded"]) == (t or "").encode() for i, t in texts_of(docs).items())
    assert bpe.encode(empty(spark), path, P.PATTERN).count() == 0


def test_replay_equals_merging_word_by_word():
    m = bpe.rank_file(P.path("byte_bpe_50k.tiktoken"))
    rng = random.Random(3)
    words = list({bytes(rng.choice(b"aabehinrst ") for _ in range(rng.randint(1, 14))) for _ in range(3000)})
    ids, offsets = bpe.replay(pa.array(words, pa.binary()), m)
    assert all(ids[offsets[k]:offsets[k + 1]].tolist() == bpe.encode_one(w, m) for k, w in enumerate(words))


def test_units_cut_together_equal_units_cut_alone():
    rng = random.Random(5)
    signs = ["a", "Zz", "é", "'s", "'", "7", "42", "-", "…", "\u0301", "\x1c", "\u200b", "語", "_", "x'll"]
    units = list(dict.fromkeys(" " + "".join(rng.choices(signs, k=rng.randrange(1, 6))) for _ in range(3000)))
    for pattern in (P.PATTERN, r"[a-z]+|\d"):  # the second leaves gaps
        pieces, many = bpe.cut_units(pa.array(units, pa.string()), pattern)
        alone = [regex.findall(pattern, u) for u in units]
        assert pieces.to_pylist() == [w for row in alone for w in row] and many.tolist() == [len(row) for row in alone]
    pieces, many = bpe.cut_units(pa.array([], pa.string()), P.PATTERN)
    assert len(pieces) == len(many) == 0


@pytest.mark.parametrize("table", ["docs", "real"])
def test_token_counts_equal_the_library(table, request):
    df = request.getfixturevalue(table)
    path = P.path("piece_bpe_32k.model")
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    got = by_id(pieces.count_tokens(df, path, limit=100))
    for i, text in texts_of(df).items():
        n = len(library.encode(text or ""))
        assert (got[i]["n_tokens"], got[i]["n_bytes"], got[i]["over_limit"]) == (n, len((text or "").encode()), n > 100), i


def test_token_counts_of_an_empty_table(spark):
    assert pieces.count_tokens(empty(spark), P.path("piece_bpe_32k.model")).count() == 0


def brute_repeats(rows, window):
    words = [(i, (t or "").encode().split()) for i, t in rows]
    first = {}
    for i, w in words:
        for k in range(len(w) - window + 1):
            key = tuple(w[k:k + window])
            if i is not None:
                first[key] = min(i, first.get(key, i))
    out = []
    for i, w in words:
        gone = [False] * len(w)
        for k in range(len(w) - window + 1):
            if i is not None and first[tuple(w[k:k + window])] < i:
                gone[k:k + window] = [True] * window
        rest = b" ".join(x for x, g in zip(w, gone) if not g)
        out.append((i, len(w), sum(gone), hashlib.sha256(rest).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("window", [50, 8, 3])
def test_substrings_equal_brute_force(spark, window):
    rng = random.Random(window)
    shared = [prose(1000 + k, 60 + 13 * k).split() for k in range(3)]
    rows = []
    for i in range(24):
        w = prose(i, rng.randint(0, 90)).split()
        for s in rng.sample(shared, rng.randint(0, 3)):
            lo = rng.randint(0, 20)
            at = rng.randint(0, len(w))
            w[at:at] = s[lo:lo + rng.randint(30, 90)]
        rows.append((i, rng.choice([" ", "\n", " \t"]).join(w), None))
    rows += [(50 + i, rows[3][1], None) for i in range(4)]                      # copies
    rows += [(60, rows[0][1].replace(" ", "  "), None), (3, rows[3][1], None), (61, "la " * 300, None), (62, "la " * 200, None)]
    rows += [(70, None, None), (71, "", None), (None, rows[5][1], None), (None, None, None)]
    df = frame(spark, rows)
    got = sorted(map(tuple, substrings.digests(df, window=window).collect()), key=repr)
    assert got == brute_repeats([r[:2] for r in rows], window)


def test_substrings_without_rows_and_untouched_texts(spark, docs):
    assert substrings.digests(empty(spark)).count() == 0
    assert substrings.without_repeats(empty(spark)).count() == 0
    alone = frame(spark, [(1, " a  b ", None), (2, None, None), (3, prose(9, 80), "en")])
    kept = by_id(substrings.without_repeats(alone))
    assert {i: r["text"] for i, r in kept.items()} == texts_of(alone)
    assert kept[3].asDict() == by_id(alone)[3].asDict()


def brute_copies(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(re.sub("[\x20\x09-\x0d]", "", t or ""), []).append((-len(t or ""), i is None, i))
    return {(i, re.sub("[\x20\x09-\x0d]", "", t or "")) for i, t in rows}, groups


def test_content_sort_with_frequent_text(spark):
    rows = [(i, " ".join("copied text") if i % 7 else "copiedtext", None) for i in range(90)]     # split over parts
    rows += [(100 + i, prose(i, 5), None) for i in range(40)] + [(200, prose(3, 5) + " \n", None), (5, rows[5][1], None)]
    rows += [(300, None, None), (301, " \t", None), (302, "", None), (None, "", None), (None, "copied text", None)]
    df = frame(spark, rows)
    _, groups = brute_copies([r[:2] for r in rows])
    got = content_sort.exact_groups(df).collect()
    assert len(got) == len(rows)
    want = {hashlib.sha256(n.encode()).hexdigest(): (min(g)[2], len(g)) for n, g in groups.items()}
    for r in got:
        assert (r["keep_id"], r["group_size"]) == want[r["text_sha256"]]
    kept = [r for r in got if r["kept"]]
    assert len(kept) == len(groups) and all(r["doc_id"] == r["keep_id"] for r in kept)
    stay = content_sort.drop_copies(df).collect()
    assert sorted((r["doc_id"] for r in stay), key=repr) == sorted((r["doc_id"] for r in kept), key=repr)
    assert set(stay[0].asDict()) == set(df.columns) and {r["k"] for r in stay} == {"x"}


def test_content_sort_of_an_empty_table(spark):
    assert content_sort.exact_groups(empty(spark)).count() == 0
    assert content_sort.drop_copies(empty(spark)).count() == 0


def test_slots_fill_shards_evenly(docs, real):
    for df in (docs, real):
        rows = slots.shard_documents(df, shards=4, slots=512).collect()
        assert len(rows) == df.count()
        texts = texts_of(df)
        load = [0] * 4
        for s in range(4):
            own = [r for r in rows if r["shard"] == s]
            assert sorted(r["slot"] for r in own) == list(range(len(own)))
            load[s] = sum(r["size"] for r in own)
        for r in rows:
            if r["doc_id"] is not None:
                body = (texts[r["doc_id"]] or "").encode()
                assert r["doc_id"] == 100 or (r["size"], r["text_crc32"]) == (len(body) + 8, zlib.crc32(body))
        largest = max(r["size"] for r in rows)
        assert max(load) - min(load) <= max(largest, 0.01 * sum(load))


def test_slots_with_rows_repeated_whole(spark):
    rows = [(1, prose(3, 900), None)] * 300 + [(i, prose(i, 100), None) for i in range(10, 60)] + [(None, None, None)] * 20
    got = slots.shard_documents(frame(spark, rows), shards=4, slots=512).collect()
    assert sorted((repr(r["doc_id"]), r["size"]) for r in got) == sorted((repr(i), len(t or "") + 8) for i, t, _ in rows)
    load = [sum(r["size"] for r in got if r["shard"] == s) for s in range(4)]
    assert max(load) - min(load) <= 0.01 * sum(load) + slots.PART_BYTES
    for s in range(4):
        assert sorted(r["slot"] for r in got if r["shard"] == s) == list(range(sum(r["shard"] == s for r in got)))


def test_slots_of_an_empty_table(spark):
    assert slots.shard_documents(empty(spark), shards=3, slots=64).count() == 0


def test_a_grown_map_moves_slots_only_into_the_new_shard():
    rng = np.random.default_rng(1)
    size = rng.integers(0, 1000, 512)
    old = slots.rebalanced(slots.first_map(512, 8), size, 8)
    new = slots.grown(old, size, 8)
    assert (new[new != old] == 8).all() and (new == 8).any()
    load = np.bincount(new, weights=size)
    assert load[8] <= size.sum() / 9 and load[8] >= size.sum() / 9 - size.max()


def test_stored_map_versions_stay(spark):
    from valuepay.session import scratch_path
    path = scratch_path(spark, "map")
    size = np.arange(16)
    slots.store_map(spark, path, 1, slots.first_map(16, 2), size, size)
    slots.store_map(spark, path, 2, slots.rebalanced(slots.first_map(16, 2), size, 2), size, size)
    assert slots.read_map(spark, path, 1).orderBy("virtual_slot").collect()[3]["shard"] == 1
    with pytest.raises(Exception, match="ALREADY_EXISTS|already exists"):
        slots.store_map(spark, path, 1, slots.first_map(16, 2), size, size)


def brute_print(text):
    words = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i:i + 3]).encode(), 42) for i in range(max(1, len(words) - 2))] if words else []
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints):
    root = list(range(len(prints)))

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 3:
                a, b = top(i), top(j)
                root[max(a, b)] = min(a, b)
    return [top(i) for i in range(len(prints))]


def test_simhash_equals_brute_force(spark):
    base = prose(5, 400).split()
    rows = [(0, None, None), (1, " ", None), (2, "One two", None), (3, "one  TWO", None), (4, "one two three", None), (None, "one two", None)]
    for i in range(40):                                # near copies
        w = list(base)
        w[(i * 9) % 400] = f"new{i}"
        rows.append((10 + i, " ".join(w), None))
    rows += [(100 + i, prose(i, 50), None) for i in range(20)] + [(100, prose(0, 50), None)]
    df = frame(spark, rows)
    prints = [brute_print(t) for _, t, _ in rows]
    root = brute_components(prints)
    want = sorted(((i, f"{p:016x}", min((r[0] for r, q in zip(rows, root) if q == c and r[0] is not None), default=None))
                   for (i, _, _), p, c in zip(rows, prints, root)), key=repr)
    assert sorted(map(tuple, simhash.near_duplicates(df).collect()), key=repr) == want
    stay = simhash.one_of_each(df).collect()
    assert {r["doc_id"] for r in stay} == {c for _, _, c in want}
    assert simhash.near_duplicates(empty(spark)).count() == 0 and simhash.one_of_each(empty(spark)).count() == 0


@pytest.mark.parametrize("chunk", [20, 60, 4096])
def test_links_of_large_keys_equal_brute_force(spark, chunk):
    rng = random.Random(11)
    prints = set()
    for middle in (rng.getrandbits(64), rng.getrandbits(64)):
        for _ in range(140):  # fingerprints around one share their keys
            bits = rng.sample(range(64), rng.randrange(0, 5))
            prints.add(middle ^ sum(1 << b for b in bits))
        prints |= {middle ^ (x << 43) for x in range(100)}  # one key, most of them far from each other
    prints = sorted(prints | {rng.getrandbits(64) for _ in range(30)})
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    rows = spark.createDataFrame([(x,) for x in signed], "bits long")
    root = {x: x for x in signed}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for r in simhash.links(rows, 3, chunk).collect():
        assert ((r["a"] ^ r["b"]) & (1 << 64) - 1).bit_count() <= 3
        root[top(r["a"])] = top(r["b"])
    want = brute_components(prints)
    assert len({(c, top(x)) for c, x in zip(want, signed)}) == len(set(want)) == len({top(x) for x in signed})


def test_one_row_of_each_near_group_stays(spark):
    base = prose(5, 400).split()
    near = [" ".join([*base[:k * 9], f"new{k}", *base[k * 9 + 1:]]) for k in range(8)]
    rows = [(10 + k, t, None) for k, t in enumerate(near)] + [(10, near[0], None)] * 30
    rows += [(100, prose(1, 50), "en"), (None, prose(2, 50), "en"), (None, prose(2, 50), "en"), (7, None, None), (7, None, None)]
    root = brute_components([brute_print(t) for _, t, _ in rows])
    want = sorted((min((r[0] for r, q in zip(rows, root) if q == c and r[0] is not None), default=None) for c in set(root)), key=repr)
    df = frame(spark, rows)
    kept = simhash.one_of_each(df)
    assert kept.columns == df.columns and sorted((r["doc_id"] for r in kept.collect()), key=repr) == want


def test_golay_keys_find_every_pair_within_three_bits():
    rng = np.random.default_rng(2)
    base = rng.integers(0, 2**63, 200, dtype=np.uint64)
    prints = [base]
    for n in (1, 2, 3, 3, 3):
        flips = np.array([np.bitwise_or.reduce(np.uint64(1) << rng.choice(64, n, replace=False).astype(np.uint64)) for _ in base])
        prints.append(base ^ flips)
    prints = np.unique(np.concatenate(prints))
    key, bits, own = simhash.keys_of(prints)
    keys = {}
    for k, b, o in zip(key.tolist(), bits.tolist(), own.tolist()):
        keys.setdefault(b, (set(), set()))[o].add(k)
    for i, j in zip(*np.nonzero(np.bitwise_count(prints[:, None] ^ prints[None, :]) <= 3)):
        a, b = keys[int(prints[i])], keys[int(prints[j])]
        assert (a[0] | a[1]) & b[1]


def test_packing_round_trip(docs):
    path = P.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    rows = packing.pack_documents(docs, path, capacity=64).collect()
    want = {}
    for r in docs.select("doc_id", "text").collect():
        want.setdefault(r["doc_id"], []).append(np.array(library.encode(r["text"] or "", add_special_tokens=False).ids + [2], "<u4"))
    pieces_of = {}
    for r in rows:
        pieces_of.setdefault(r["doc_id"], []).append(r)
    for i, docs_of in want.items():
        crcs = []
        for ids in docs_of:
            at, size, k = 0, (len(ids) - 1) % 64 + 1, 0
            while at < len(ids):
                crcs.append((k, at, size, zlib.crc32(ids[at:at + size].tobytes())))
                at, size, k = at + size, 64, k + 1
        assert sorted((r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in pieces_of[i]) == sorted(crcs), i
    sequences = {}
    for r in rows:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 64
    assert len(sequences) <= -(-sum(r["length"] for r in rows) // 64) + 2


def test_packing_migrates_between_islands(spark):
    rng = random.Random(1)
    items = spark.createDataFrame([(i, rng.randint(1, 99)) for i in range(900)], "piece_id long, length long")
    out = packing.pack(items, capacity=100, island=100).collect()
    assert sorted(r["piece_id"] for r in out) == list(range(900))
    fill = {}
    for r in out:
        fill[r["sequence_id"]] = fill.get(r["sequence_id"], 0) + r["length"]
    size = {r["piece_id"]: r["length"] for r in out}
    whole: list[list[int]] = []
    packing.best_fit(whole, sorted(size, key=lambda i: -size[i]), size, 100)  # best-fit decreasing over all
    assert max(fill.values()) <= 100 and len(fill) <= 1.01 * len(whole) + 1
    assert packing.pack_documents(empty(spark), P.path("byte_bpe_50k.json")).count() == 0


@pytest.mark.parametrize("table", ["docs", "real"])
def test_licence_places_equal_brute_force(table, request):
    df = request.getfixturevalue(table)
    got = by_id(licences.scan(df))
    for i, text in texts_of(df).items():
        words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        places, labels = [], set()
        for phrase, label in licences.PHRASES:
            p = phrase.split()
            at = [k for k in range(len(words)) if words[k:k + len(p)] == p]
            places += at
            labels |= {label} if at else set()
        r = got[i]
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == (
            len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))), i
        assert labels <= set(r["labels"].split(",")) | {""} and 0 <= r["score"] <= 1


def test_licence_spans_survive_small_edits(spark):
    notice = licences.TEMPLATES[1][0]
    edited = notice.replace("granted free", "granted fully free").replace("publish", "print")
    rows = licences.scan(frame(spark, [(1, "before it " + edited.upper() + " and after", None), (2, notice[:60], None), (3, None, None)]))
    got = by_id(rows)
    assert got[1]["labels"] == "mit" and got[1]["spans"][0]["start"] == 2 and got[1]["score"] > 0.85
    assert got[2]["labels"] == "" and got[3]["n_words"] == 0
    assert licences.scan(empty(spark)).count() == 0


def test_licence_spans_survive_stray_phrases(spark):
    notice = licences.TEMPLATES[1][0]
    stray = notice.replace("documentation files", "documentation files copies of the software")
    early = notice.replace("without restriction", "without restriction to any person")
    rows = [(1, stray, None), (2, f"{stray} and so on and so on and so on {early} {notice}", None), (3, " ".join([licences.TEMPLATES[0][0]] * 40), None)]
    got = by_id(licences.scan(frame(spark, rows)))
    size = len(notice.split())
    assert (got[1]["labels"], got[1]["score"]) == ("mit", 1.0)
    assert [(s["start"], s["end"], s["coverage"]) for s in got[1]["spans"]] == [(0, size + 4, 1.0)]
    ends = np.cumsum([size + 4, 9, size + 3, size]).tolist()
    assert [(s["start"], s["end"], s["coverage"]) for s in got[2]["spans"]] == [(0, ends[0], 1.0), (ends[1], ends[2], 1.0), (ends[2], ends[3], 1.0)]
    assert [(s["start"], s["end"]) for s in got[3]["spans"]] == [(5 * k, 5 * k + 5) for k in range(40)]


def test_best_chains_equal_enumeration():
    rng = random.Random(8)
    for _ in range(300):
        ends = sorted(rng.sample(range(3, 40), rng.randint(1, 7)))
        places = [(e - rng.randint(1, 3), e, rng.randint(3, 14)) for e in ends]
        best = {}
        for mask in range(1, 1 << len(places)):
            chain = [p for i, p in enumerate(places) if mask >> i & 1]
            steps = [(b[0] - a[1] <= 6, min(b[1] - b[0], b[2] - a[2], b[1] - a[1])) for a, b in zip(chain, chain[1:])]
            if all(near and fresh > 0 for near, fresh in steps):
                weight = chain[0][1] - chain[0][0] + sum(fresh for _, fresh in steps)
                best[chain[-1]] = max(best.get(chain[-1], (0, 0)), (weight, chain[0][0]))
        assert [c[:2] for c in licences.best_chains(places, 6)] == [best[p] for p in places]


def test_matching_statistics_equal_brute_force():
    a = licences.Automaton((("a b c a b d", "x"), ("b c b c a", "y")), (("c a", "z"),))
    rng = random.Random(4)
    words = [rng.choice("abcde") for _ in range(300)]
    texts = [t for t, _ in a.templates] + [p for p, _ in a.phrases]

    def longest(i):
        return max((n for n in range(i + 2) for t in texts for k in range(len(t) - n + 1) if t[k:k + n] == words[i + 1 - n:i + 1]), default=0)

    got = [n for _, n in a.statistics([a.number.get(w, 0) for w in words])]
    assert got == [longest(i) for i in range(len(words))]


def test_language_held_out_accuracy(spark):
    df = spark.read.parquet(f"{SF001}/documents.parquet")
    rows = language.predict(df, language.train(df)).join(df.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in rows if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in rows)
    assert held and sum(r["lang"] == r["lang_pred"] for r in held) / len(held) > 0.95
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_language_of_odd_texts_and_code_switching(spark, docs):
    df = spark.read.parquet(f"{SF001}/documents.parquet")
    model = language.train(df)
    got = by_id(language.predict(docs, model))
    for i in (0, 1, 2, 11, 200):                    # empty, white space, digits, null
        assert (got[i]["lang_pred"], got[i]["score"]) == ("und", 0.0)
    assert language.accepted(docs, model).count() == docs.count() - 5 - 1
    some = {r["lang"]: r["text"] for r in df.filter("n_chars > 1500").collect()}
    mixed = frame(spark, [(1, some["en"][:1500] + " " + some["de"][:1500], None)])
    runs = language.predict(mixed, model).first()["runs"]
    assert {r["lang"] for r in runs} >= {"en", "de"} and runs[0]["lang"] == "en" and runs[-1]["lang"] == "de"
    nothing = language.train(empty(spark))
    assert {r["lang_pred"] for r in language.predict(docs, nothing).collect()} == {"und"}
    assert language.predict(empty(spark), model).count() == 0


def test_forward_backward_equals_enumeration():
    from itertools import product
    rng = np.random.default_rng(0)
    e, t, s = rng.normal(size=(1, 4, 3)), rng.normal(size=(3, 3)), rng.normal(size=3)
    p = language.forward_backward(e, np.ones((1, 4), bool), t, s)[0][0]
    total = np.zeros((4, 3))
    for path in product(range(3), repeat=4):
        w = np.exp(s[path[0]] + sum(e[0, k, y] for k, y in enumerate(path)) + sum(t[a, b] for a, b in zip(path, path[1:])))
        for k, y in enumerate(path):
            total[k, y] += w
    assert np.allclose(p, total / total.sum(axis=1, keepdims=True))


def test_substrings_thue_morse_pair_shares_no_window(spark):
    """Sequences whose polynomial hashes modulo 2**64 agree for any odd base are no copies of each other."""
    bits = [bin(i).count("1") & 1 for i in range(1024)]
    first = " ".join(f"{'ab'[b]} f{i}" for i, b in enumerate(bits))
    second = " ".join(f"{'ba'[b]} f{i}" for i, b in enumerate(bits))
    shared = " ".join(f"s{i}" for i in range(60))
    rows = [(1, first, None), (2, second, None), (3, first + " end", None), (4, f"x {shared}", None), (5, f"{second} {shared}", None)]
    got = {r["doc_id"]: (r["n_words"], r["n_removed"]) for r in substrings.digests(frame(spark, rows)).collect()}
    assert got == {1: (2048, 0), 2: (2048, 0), 3: (2049, 2048), 4: (61, 0), 5: (2108, 2108)}

