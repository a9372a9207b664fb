"""Tokens, their alignment and prefix tries against the libraries themselves and plain Python."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import public_tokenizers
import pytest
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from hazeline.llm import alignment, bpe, prefixes

WORDS = public_tokenizers.path("word_bpe_49k.json")
A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
DOCS = "doc_id long, text string, ids string, decoded string, batch string, n_a int, pair int"


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(11)
    letters = "abcdeabc'''stremdlvéßñÀＡ日本語😂😂٣１Ⅷ   \x1c\x85​́İſǅ!?--_0123<|>▁\n\t"
    out = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 60))) for _ in range(300)]
    words = "the quick brown foxes unbelievably antidisestablishmentarianism l'été straße naïve 日本語 don't we'll x86_64 3.14159".split()
    out += [" ".join(rng.choice(words) for _ in range(rng.randint(1, 40))) for _ in range(100)]
    out += ["a<|endoftext|>b 's<|startoftext|><|endoftext|>x", "it's we'll they're 's''s 'st'rest I'd'd", "", None, "   \n", "a" * 3000,
            "😂" * 300, "the" * 2000, "<|endoftext|>", "x'S y'LL Σ ΟΔΟΣ.", "<s> </s> <unk> <0x41>", "  two  blanks", "▁ bar", "\x00 null"]
    return out + ["same text twice", "same text twice"]


def docs(spark, texts):
    rows = [(i if i % 17 else None, t, "x", "y", "z", 1, 2) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS).repartition(3)


def test_encoding_matches_the_library(spark, texts):
    library = Tokenizer.from_file(WORDS)
    library.no_truncation()
    library.no_padding()
    want = Counter()
    for i, t in enumerate(texts):
        ids = library.encode(t, add_special_tokens=False).ids if t else []
        want[i if i % 17 else None, t, tuple(ids), library.decode(ids, skip_special_tokens=False)] += 1
    out = bpe.decoded(bpe.encoded(docs(spark, texts), WORDS), WORDS)
    assert set(out.columns) == {"doc_id", "text", "ids", "decoded", "batch", "n_a", "pair"}
    assert Counter((r["doc_id"], r["text"], tuple(r["ids"]), r["decoded"]) for r in out.collect()) == want
    assert bpe.encoded(docs(spark, texts).limit(0), WORDS).count() == 0


def test_pairs_decide_whether_a_proposal_stands():
    model = bpe.tokens(WORDS).model
    rng = random.Random(3)
    names = [t for t in model.ids if not t.endswith("</w>") and model.sound[model.ids[t]]]
    ends = [t for t in model.ids if t.endswith("</w>") and model.sound[model.ids[t]]]
    pairs = [(rng.choice(names), rng.choice(ends)) for _ in range(4000)]
    pairs += [(t, t + "</w>") for t in names if t + "</w>" in model.ids][:2000]
    import numpy as np

    a, b = (np.array([model.ids[p[i]] for p in pairs]) for i in (0, 1))
    got = model.compatible(a, b)
    for (x, y), i, j, g in zip(pairs, a.tolist(), b.tolist(), got.tolist()):
        assert g == (model.merged(x + y.removesuffix("</w>")) == [i, j]), (x, y)


def test_unusual_merges_fall_back_to_exact_merging():
    vocabulary = {t: i for i, t in enumerate(["a", "b", "a</w>", "b</w>", "aa", "ab", "aab", "aab</w>", "ab</w>"])}
    merges = [["a", "a"], ["aa", "b"], ["a", "ab"], ["a", "b"], ["a", "b</w>"], ["a", "ab</w>"]]
    model = bpe.Merges({"vocab": vocabulary, "merges": merges, "end_of_word_suffix": "</w>"})
    assert not model.regular
    for w in ("a", "ab", "aab", "aaab", "abab", "aabaab"):
        assert model.encode([w]) == [model.merged(w)]


def test_words_are_proposed_and_merged_side_by_side(monkeypatch):
    model = bpe.tokens(WORDS).model
    rng = random.Random(8)
    parts = ["of", "er", "the", "tion", "nt", "in", "ed", "an", "sh", "o", "h", "e", "re", "Ã©", "Ã", "\u0120", "日"]
    words = ["".join(rng.choice(parts) for _ in range(rng.randint(1, 9))) for _ in range(3000)] + ["日", "日a", "a日"]
    longer = ["".join(rng.choice(parts) for _ in range(60)) for _ in range(5)] + ["a" * 500, "the" * 40]
    want = [model.merged(w) for w in words + longer]
    proposals = [model.greedy(w) for w in words]
    assert sum(p != w for p, w in zip(proposals, want)) > 1000
    flat, n = model.proposed(words)
    assert flat.tolist() == [t for p in proposals for t in p or []] and n.tolist() == [len(p or []) for p in proposals]
    assert model.encode(words + longer) == want

    def one_by_one(self, word):
        raise AssertionError(word)

    monkeypatch.setattr(bpe.Merges, "merged", one_by_one)
    monkeypatch.setattr(bpe.Merges, "greedy", one_by_one)
    assert model.encode(words) == want[:len(words)]


def aligned_by_hand(texts):
    one, two = Tokenizer.from_file(A), SentencePieceProcessor(model_file=B)
    one.encode_special_tokens = True
    letters = {c: b for b, c in bpe.byte_letters().items()}
    cut = []
    for t in texts:
        ids_a = one.encode(" " + t, add_special_tokens=False).ids if t else []
        ids_b = two.encode(t) if t else []
        raw_a = [bytes(letters[c] for c in one.id_to_token(i)) for i in ids_a]
        raw_b = [bytes([int(two.id_to_piece(i)[3:5], 16)]) if two.is_byte(i) else two.id_to_piece(i).replace("▁", " ").encode() for i in ids_b]
        raw = (" " + (t or "")).encode()
        if b"".join(raw_a) != raw or b"".join(raw_b) != raw:
            ids_a, ids_b, raw_a, raw_b = [], [], [], []
        ends = []
        for pieces in (raw_a, raw_b):
            at, e = 0, []
            for p in pieces:
                at += len(p)
                e.append(at)
            ends.append(e)
        links = [(i, j) for i, x in zip(ids_a, ends[0]) for j, y in zip(ids_b, ends[1]) if x == y]
        groups, i, j = [], 0, 0
        for e in sorted(set(ends[0]) & set(ends[1])):
            x, y = ends[0].index(e) + 1, ends[1].index(e) + 1
            groups.append(",".join(map(str, ids_a[i:x])) + "|" + ",".join(map(str, ids_b[j:y])))
            i, j = x, y
        shared, start_a = 0, 0
        for e in ends[0]:
            start_b = 0
            for f in ends[1]:
                shared += start_a < f and start_b < e
                start_b = f
            start_a = e
        cut.append((len(ids_a), len(ids_b), links, ";".join(groups), shared))
    return cut


def test_alignment_by_hand(spark, texts):
    texts = [t for t in texts if t is None or len(t) < 1000]
    cut = aligned_by_hand(texts)
    count = Counter(p for c in cut for p in c[2])
    most = defaultdict(int)
    for (_, j), n in count.items():
        most[j] = max(most[j], n)
    want = Counter()
    for i, (n_a, n_b, links, groups, shared) in enumerate(cut):
        digest = hashlib.sha256(groups.encode()).hexdigest() if n_a else ""
        want[i if i % 17 else None, n_a, n_b, len(links), len(links), shared, sum(count[p] == most[p[1]] for p in links),
             sum(count[p] for p in links), digest] += 1
    assert sum(1 for c in cut if not c[0]) >= 4 and len({c[0] for c in cut}) > 20
    columns = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_overlaps", "n_best", "count_sum", "groups_sha256")
    keep = alignment.SLICE, alignment.BATCH
    got = alignment.token_alignment(docs(spark, texts), A, B).collect()
    assert Counter(tuple(r[c] for c in columns) for r in got) == want
    assert (alignment.SLICE, alignment.BATCH) == keep
    assert alignment.token_alignment(docs(spark, texts).limit(0), A, B).count() == 0


def test_batches_of_any_size_align_alike(texts):
    one, two = alignment.side(A), alignment.side(B)
    texts = texts[:200]
    whole, of, links = alignment._linked(texts, one, two)
    parts = [alignment._linked(texts[i:i + 1], one, two) for i in range(len(texts))]
    assert whole["groups"] == [g for p in parts for g in p[0]["groups"]]
    assert links.tolist() == [x for p in parts for x in p[2].tolist()]


def test_each_distinct_unit_is_aligned_once(texts, monkeypatch):
    asked = []
    whole = alignment._units_linked
    monkeypatch.setattr(alignment, "_units_linked", lambda units, *sides: asked.extend(units) or whole(units, *sides))
    memory = alignment.Units(alignment.side(A), alignment.side(B))
    monkeypatch.setattr(alignment, "units", lambda *sides: memory)
    rng = random.Random(5)
    odd = ["".join(rng.choice("ab'st.,\n\n\t\r   \u2028\u0301é1٣!▁日ﬁ\x01") for _ in range(rng.randint(0, 40))) for _ in range(1500)]
    texts = ["the cat. the cat,\nthe cat"] * 3 + odd + [t for t in texts if t and len(t) < 1000]
    got, of, links = alignment._linked(texts, *memory.sides)
    assert len(asked) == len(set(asked)) and {" the", " cat", ".", ",", "\n", "the"} <= set(asked)
    assert all("".join(memory.of(t)) == " " + t for t in texts)
    cut = aligned_by_hand(texts)
    assert [*zip(got["n_a"], got["n_b"], got["n_links"], got["groups"], got["n_overlaps"])] == [(a, b, len(x), g, s) for a, b, x, g, s in cut]
    assert [*zip(of.tolist(), links.tolist())] == [(d, i * alignment._SIDE + j) for d, c in enumerate(cut) for i, j in c[2]]


def trie_by_hand(rows, step=20, heads=4):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            name = hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
            own[c].append(((turn is not None, turn or 0, name), (role, text)))
    own = {c: [t for _, t in sorted(v)] for c, v in own.items()}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % heads
        built[c] = own.get(c - c % step, [])[:h] + turns[h:]
    members = defaultdict(list)
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    words = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t))
    value = {p: (len(m) - 1) * words(p[-1][1]) if p else 0 for p, m in members.items()}
    parents = Counter(p[:-1] for p in members if p)
    saved, leaves = Counter(), Counter()
    for p in members:
        for d in range(len(p) + 1):
            saved[p[:d]] += value[p]
            leaves[p[:d]] += not parents[p]
    out = Counter()
    for p, m in members.items():
        ends = ",".join(map(str, sorted(c for c in m if len(built[c]) == len(p))))
        out[min(m), len(p), min(members[p[:-1]]) if p else None, len(m), parents[p], leaves[p], saved[p],
            hashlib.sha256(ends.encode()).hexdigest()] += 1
    return out


TURNS = "conv_id long, turn long, role string, text string, pos int, block string, k1 long, `last` string, part int"


def turns_of(spark, rows):
    return spark.createDataFrame([(*r, 1, "b", 2, "l", 3) for r in rows], TURNS).repartition(3)


def got_of(out):
    columns = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
    return Counter(tuple(r[c] for c in columns) for r in out.collect())


@pytest.fixture(scope="module")
def turns():
    rng = random.Random(2)
    rows = []
    for c in [*range(0, 90), 105, 1000, 1003, 20000, 4096, 8192, 123456789012]:
        for i in range(rng.choice([1, 1, 2, 3, 5, 8, 9, 17])):
            rows.append((c, i, rng.choice(["user", "assistant", None]) if i else "user", rng.choice(["hello there", "a b c", "", None, "one"])))
    rows += [(7, None, "system", "null turn"), (7, 0, "user", "tie b"), (7, 0, "user", "tie a"), (7, 0, "user", "tie a"), (None, 0, "user", "no id"),
             (11, 5, "us", "erx"), (12, 5, "use", "rx")]
    rows += [(c, i, "user", f"long {i}") for c in (40, 41, 43) for i in range(100, 300 + c)]
    return rows


def test_trie_by_hand(spark, turns, monkeypatch):
    want = trie_by_hand(turns)
    assert got_of(prefixes.prefix_trie(turns_of(spark, turns))) == want
    # short chunks: long conversations and lists of ids go through the carries
    monkeypatch.setattr(prefixes, "CHUNK", 3)
    monkeypatch.setattr(prefixes, "IDS", 5)
    assert got_of(prefixes.prefix_trie(turns_of(spark, turns))) == want


def test_trie_of_odd_tables(spark):
    assert prefixes.prefix_trie(turns_of(spark, []).limit(0)).count() == 0
    for rows in ([(5, 0, "user", "x")], [(1, 0, "u", "x" * 100_000), (2, 0, "u", "x" * 100_000), (3, None, None, None)]):
        assert got_of(prefixes.prefix_trie(turns_of(spark, rows))) == trie_by_hand(rows)
    same = [(c, i, "u", f"t{i}") for c in range(600) for i in range(5)]
    assert got_of(prefixes.prefix_trie(turns_of(spark, same))) == trie_by_hand(same)
