"""Operators 11 to 13 against brute force: nulls, empty and long texts, ties, repeats, empty tables, clashing columns."""

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import public_tokenizers
import pytest

from mapjobs.llm import importance, repair, token_counts

BPE, PIECES, WORDS = (public_tokenizers.path(x) for x in ("byte_bpe_50k.json", "piece_bpe_32k.model", "word_bpe_49k.json"))
SCHEMA = "doc_id long, text string, digest string, miss int, chosen int, n_bytes string, score string, rank int, weight string, one int, salt int"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "x", 1, 2, "y", "z", 3, "w", 4, 5) for i, t in rows], SCHEMA)


def prose(seed, n):
    r = random.Random(seed)
    return " ".join("".join(r.choices(["the", "Ing", "er", "ön", "re", "7", "and", "中文"], k=r.randint(1, 4))) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    texts = [prose(1, 60), prose(1, 60), None, "", " ", "<|endoftext|> in a <|endoftext|>text", "don't  stop...\n\n\n x", prose(2, 30_000), "a" * 9000, "Ünï ß\t中文  x", "...", "word"]
    return [*enumerate(texts), (None, prose(1, 60)), (None, "only null ids"), (7, "other text of a repeated id"), (3, ""), (11, "word"), (12, prose(3, 25)), (13, prose(3, 25))]


def in_order(found):
    return sorted(found, key=repr)


@pytest.mark.parametrize("path", [BPE, PIECES, WORDS])
def test_token_counts(spark, rows, path):
    if path == PIECES:
        import sentencepiece

        count = lambda t: len(sentencepiece.SentencePieceProcessor(model_file=path).encode(t))
    else:
        from tokenizers import Tokenizer

        library = Tokenizer.from_file(path)
        count = lambda t: len(library.encode(t, add_special_tokens=False).ids)
    want = [(i, len((t or "").encode()), count(t or ""), count(t or "") > 512) for i, t in rows]
    for few in (0, 1):  # the texts are shuffled; the digests are sent
        got = token_counts.count_tokens(frame(spark, rows), path, few=few).collect()
        assert in_order(tuple(r) for r in got) == in_order(want)


def test_count_cache(spark, rows, tmp_path):
    cache = str(tmp_path / "counts")
    stored = lambda: spark.read.parquet(cache)
    first = token_counts.count_tokens(frame(spark, rows), BPE, cache=cache).collect()
    assert stored().count() == len({t or "" for _, t in rows})  # copies are encoded once
    assert in_order(token_counts.count_tokens(frame(spark, rows), BPE, cache=cache).collect()) == in_order(first)
    assert stored().count() == len({t or "" for _, t in rows})  # nothing is new
    more = token_counts.count_tokens(frame(spark, [*rows, (90, "quite new"), (91, "quite new")]), BPE, cache=cache, few=0)
    assert more.count() == len(rows) + 2 and stored().count() == len({t or "" for _, t in rows}) + 1
    # counts are taken from the cache, but only those of the tokenizer's own version
    version = token_counts.version_of(BPE)
    spark.createDataFrame([(version, hashlib.sha256(b"planted").digest(), 777)], token_counts.CACHE).write.mode("append").parquet(cache)
    planted = frame(spark, [(1, "planted")])
    assert token_counts.count_tokens(planted, BPE, cache=cache).first()["n_tokens"] == 777
    assert token_counts.count_tokens(planted, WORDS, cache=cache).first()["n_tokens"] < 5
    assert token_counts.count_tokens(frame(spark, []), BPE).collect() == []
    by_text = spark.createDataFrame([("b", "one two"), (None, "one two")], "doc_id string, text string")
    assert {r["n_tokens"] for r in token_counts.count_tokens(by_text, BPE).collect()} == {2}


def brute_repair(rows):
    """(gaps .. repaired_sha256) of one conversation's rows (turn, role, text), trying all edits with two inserts at most between rows."""
    rows = sorted(((t is not None, t or 0, r, x, t) for t, r, x in rows))
    rows = [(t, r, x) for _, _, r, x, t in rows]
    seen, faults = set(), []
    for _, role, text in rows:
        last = re.findall(r"[^\x20\x09-\x0D]", text)[-1:]
        faults.append("b" if not last else "d" if (role, text) in seen else "t" if last[0] not in ".!?" else "")
        seen.add((role, text))
    fills = ["", *"ua", "ua", "au"]
    options = []
    for (_, role, text), fault in zip(rows, faults):
        edits = [("D", 2, [])]
        if fault not in ("b", "d"):
            more = 5 * (fault == "t")
            edits += [("K", more, [(role, text)])] + [("R", 1 + more, [(x, text)]) for x in ("user", "assistant")]
        options.append([(f, *e) for f in fills for e in edits])
    best = None
    named = {"u": "user", "a": "assistant"}
    for picks in itertools.product(*options):
        for tail in fills:
            cost = sum(5 * len(f) + c for f, _, c, _ in picks) + 5 * len(tail)
            audit = "".join("I" * len(f) + e for f, e, _, _ in picks) + "I" * len(tail)
            if best and (cost, audit) > best[:2]:
                continue
            made = [x for f, _, _, kept in picks for x in [*((named[c], "") for c in f), *kept]] + [(named[c], "") for c in tail]
            if re.fullmatch("(s?(ua)+)?", "".join(r[:1] or "-" for r, _ in made)):
                best = (cost, audit, hashlib.sha256("\n".join(f"{r}:{t}" for r, t in made).encode()).hexdigest())
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    firsts = [r[:1] for _, r, _ in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(firsts, firsts[1:]))
    return (gaps, *(faults.count(x) for x in "bdt"), illegal, *best)


CONV = "conv_id long, turn long, role string, text string, dropped boolean, conv string, same string, nth int, first int"


def test_repair(spark):
    r = random.Random(5)
    convs = {}
    for c in [None, *range(60)]:
        n = r.randint(0, 4)
        turns = [r.choice([None, *range(7)]) for _ in range(n)]
        convs[c] = [(t, r.choice(["system", "user", "user", "assistant", "assistant", "tool", "", "Sx", "u"]), r.choice(["a.", "b!", "a.", "c", "c \n", "d? ", "", " ", "é"])) for t in turns]
    rows = [(c, *x, False) for c, xs in convs.items() for x in xs] + [(c, 3, "user", "never seen", True) for c in convs]
    df = spark.createDataFrame([(*x, "c", "s", 1, 2) for x in rows], CONV)
    got = {x["conv_id"]: tuple(x)[1:] for x in repair.repaired(df).collect()}
    assert got == {c: brute_repair(xs) for c, xs in convs.items()}
    assert got == {x["conv_id"]: tuple(x)[1:] for x in repair.repaired(df, kept_bytes=4).collect()}  # all choices go to a file
    assert repair.repaired(df.limit(0)).collect() == []
    nulls = spark.createDataFrame([(1, 1, None, None, None), (1, None, "user", "x.", None), (2, None, None, "y.", None)], "conv_id long, turn long, role string, text string, dropped boolean")
    found = {x["conv_id"]: x for x in repair.repaired(nulls).collect()}
    assert found[1]["blank"] == 1 and found[1]["gaps"] == 0 and found[1]["audit"] == "DD" and found[2]["audit"] == "D"


def test_repair_of_a_long_conversation(spark):
    """One conversation over many Arrow batches; choices in a file or in memory, the same."""
    n = 30_000
    r = random.Random(2)
    texts = [f"{i} {r.choice(['.', '!', 'x'])}" for i in range(n)]
    rows = [(7, i, r.choice(["user", "assistant", "assistant"]), texts[i], False) for i in range(n)] + [(8, 0, "user", "a.", False), (8, 1, "assistant", "b.", False)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, dropped boolean")
    a, b = ({x["conv_id"]: x for x in repair.repaired(df, kept_bytes=k).collect()} for k in (1000, 1 << 20))
    assert a == b and a[8]["audit"] == "KK" and a[8]["cost"] == 0
    x = a[7]
    assert x["audit"].count("K") + x["audit"].count("R") + x["audit"].count("D") == n
    # the audit replayed gives the hash, the cost and a legal order
    left, made, cost, state = iter(rows[:n]), [], 0, ""
    for e in x["audit"]:
        nxt = "assistant" if state == "u" else "user"
        if e == "I":
            made.append(f"{nxt}:")
            cost, state = cost + 5, nxt[0]
            continue
        _, _, role, text, _ = next(left)
        cost += 5 * (e != "D" and text[-1] == "x") + {"K": 0, "R": 1, "D": 2}[e]
        if e != "D":
            role = nxt if e == "R" else role
            assert (role[0], state) in (("u", ""), ("u", "a"), ("a", "u"))
            made.append(f"{role}:{text}")
            state = role[0]
    assert state == "a" and cost == x["cost"] and hashlib.sha256("\n".join(made).encode()).hexdigest() == x["repaired_sha256"]


def test_damage(spark):
    rows = [(c, t, r, x) for c in (None, 1, 2, 5) for t in (None, *range(30)) for r, x in (("user", "a. b! c?"), (None, None))]
    df = spark.createDataFrame([(*x, 9) for x in rows], "conv_id long, turn long, role string, text string, times int")
    want = []
    for c, t, role, text in rows:
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role, text = role or " ", text or " "
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        want += [(c, t, "user" if kind == 4 else role, text, kind == 0)] * (2 if kind == 3 else 1)
    assert in_order(tuple(x) for x in repair.damaged(df).collect()) == in_order(want)
    assert {x[4] for x in want} == {True, False}


def words_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def brute_resample(docs, target, longest, percent, least):
    def features(text):
        w = words_of(text)
        return [zlib.crc32(" ".join(w[i:i + k]).encode()) % 10_000 for k in range(1, longest + 1) for i in range(len(w) - k + 1)]

    s, t = (Counter(b for x in xs for b in features(x)) for xs in ([x for _, x in docs], target))
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = defaultdict(int, {b: math.floor(1000 * math.log((t[b] + 1) * (all_s + 10_000) / ((s[b] + 1) * (all_t + 10_000)))) for b in s})
    out = []
    for i, x in docs:
        f = features(x)
        weight = sum(gain[b] for b in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, len(words_of(x)), len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), None])
    able = sorted((x for x in out if x[1] >= least), key=lambda x: (-x[4], x[0] is None, x[0] or 0))
    for k, x in enumerate(able[:percent * len(able) // 100], 1):
        x[5] = k
    return [tuple(x) for x in out]


@pytest.mark.parametrize("longest,percent,least", [(1, 10, 20), (3, 50, 1), (2, 100, 0), (1, 0, 20)])
def test_resample(spark, rows, longest, percent, least):
    docs = [*rows, *((100 + i, prose(i % 40, 22)) for i in range(200))]
    target = [prose(8, 50), None, "", prose(9, 70), prose(8, 50)]
    bench = spark.createDataFrame([(str(i), t) for i, t in enumerate(target)], "item_id string, text string")
    got = importance.resample(frame(spark, docs), bench, longest=longest, percent=percent, least_words=least).collect()
    want = brute_resample(docs, target, longest, percent, least)
    assert in_order(tuple(x)[:5] for x in got) == in_order(x[:5] for x in want)
    # rows that share score and id may change places
    assert in_order((x["score"], x["doc_id"], x["rank"]) for x in got) == in_order((x[4], x[0], x[5]) for x in want)


def test_resample_of_empty_tables(spark, rows):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert importance.resample(none, frame(spark, rows)).collect() == []
    got = importance.resample(frame(spark, rows), none, percent=50).collect()
    assert in_order((x["doc_id"], x["weight"]) for x in got) == in_order((x[0], x[3]) for x in brute_resample(rows, [], 1, 50, 20))


def test_hashes_in_pieces():
    """A text cut anywhere has the features of the whole."""
    for seed, size, longest in itertools.product(range(5), (1, 7, 64, 1 << 20), (1, 2, 4)):
        text = prose(seed, 40) + "  -- " + "b" * 600 + " é"
        w = [x.encode() for x in words_of(text)]
        want = Counter(zlib.crc32(b" ".join(w[i:i + k])) for k in range(1, longest + 1) for i in range(len(w) - k + 1))
        found = [*importance.hashes(text.encode(), longest, size)]
        assert Counter(h for _, hs in found for h in hs) == want and sum(n for n, _ in found) == len(w)


