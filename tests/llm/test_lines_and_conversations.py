"""Line deduplication, the prefix trie of conversations and their repair, against brute force, with messy tables."""

import hashlib
import itertools
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from panelspark.llm import conversation_repair, line_dedup, prefix_trie
from panelspark.llm.conversation_repair import before, least_edits, power, times

BLANKS = " \t\n\x0b\x0c\r"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# --- 12 line dedup


def line_rows():
    rng = random.Random(3)
    lines = [f"line {i}" for i in range(40)] + ["", "  ", "x", "Éa", "éA", " Shared  Line\t", "shared  line"]
    rows = [(i, "\n".join(rng.choice(lines) for _ in range(rng.randrange(1, 12)))) for i in range(60)]
    rows += [(100 + i, "SHARED  line\nown %d" % i) for i in range(300)]  # a line that most documents hold
    rows += [(500, None), (501, ""), (502, "\n\n"), (None, "line 1\nline 1"), (None, "shared  line"), (7, "line 2\nalone"), (8, rows[8][1])]
    rows += [(600, "long line\n" * 20_000 + "end"), (601, "a" * 300_000)]
    rng.shuffle(rows)
    return rows


def brute_lines(rows, least_docs, least_points, keep_first):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    key = lambda line: line.strip(BLANKS).translate(lower)
    holders, split = defaultdict(set), [(i, (t or "").split("\n")) for i, t in rows]
    for i, lines in split:
        for x in lines:
            holders[key(x)].add(i)
    often = {k for k, v in holders.items() if len(v) >= least_docs and len(k) >= least_points}
    order = sorted(range(len(rows)), key=lambda r: (rows[r][0] is not None, rows[r][0] or 0))
    first = {}
    for r in order:
        for at, x in enumerate(split[r][1]):
            first.setdefault(key(x), (split[r][0], at))
    out = []
    for i, lines in split:
        keep = [x for at, x in enumerate(lines) if key(x) not in often or (keep_first and first[key(x)] == (i, at))]
        out.append((i, len(lines), len(lines) - len(keep), "\n".join(keep)))
    return sorted(out, key=str)


@pytest.mark.parametrize(("least_docs", "least_points"), [(10, 1), (2, 1), (3, 5), (400, 1)])
def test_lines_by_force(spark, least_docs, least_points):
    rows = line_rows()
    docs = spark.createDataFrame([(i, t, "a", "b", "c") for i, t in rows], "doc_id long, text string, row string, at string, keep string").repartition(5)
    bitmaps = line_dedup.keep_bitmaps(docs, least_docs, least_points, keep_first=False)
    got = sorted([tuple(r) for r in line_dedup.kept_texts(docs, bitmaps).collect()], key=str)
    assert got == brute_lines(rows, least_docs, least_points, False)
    digests = sorted([tuple(r) for r in line_dedup.kept_texts(docs, bitmaps, digest=True).collect()], key=str)
    assert digests == sorted([(*x[:3], sha(x[3])) for x in got], key=str)


def test_first_lines_stay(spark):
    rows = [r for r in line_rows() if r[0] not in (None, 7, 8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = line_dedup.kept_texts(docs, line_dedup.keep_bitmaps(docs)).collect()
    assert sorted(map(tuple, got), key=str) == brute_lines(rows, 2, 1, True)


def test_lines_of_nothing(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert line_dedup.kept_texts(docs, line_dedup.keep_bitmaps(docs)).count() == 0


@pytest.mark.parametrize("seed", range(30))
@pytest.mark.parametrize("keep_first", [False, True])
def test_ranges_of_lines_by_force(seed, keep_first):
    """Any cut into ranges and batches gives what a whole pass gives."""
    rng = random.Random(seed)
    least = rng.choice([1, 2, 3, 10])
    rows = sorted({(rng.randrange(4), 0, rng.randrange(-1, 9), 0, at) for at in range(rng.randrange(1, 80))})
    groups = [list(g) for _, g in itertools.groupby(rows, key=lambda r: r[:3])]
    cuts = sorted(rng.sample(range(len(groups) + 1), min(len(groups) + 1, rng.randrange(5))))
    parts = [[r for g in groups[a:b] for r in g] for a, b in itertools.pairwise([0, *cuts, len(groups)])]
    told = []
    for number, part in enumerate(parts):
        runs = line_dedup.Runs(least, keep_first, number)
        while part:
            size = rng.randrange(1, 9)
            h1, h2, doc, row, at = (np.array(c, np.int64) for c in zip(*part[:size], strict=True))
            known = doc >= 0
            runs.feed({"row": row, "at": at, "h1": h1, "h2": h2, "doc": np.where(known, doc, 0), "known": known, "doc_id": np.where(known, doc.astype(object), None)})
            part = part[size:]
        runs.close(True)
        told += [dict(zip(b.schema.names, x, strict=True)) for b in runs.taken() for x in zip(*(c.to_pylist() for c in b.columns), strict=True)]
    edges = [x for x in told if x["docs"] is not None]
    dropped = {(x["doc_id"], x["at"]) for x in told if x["dropped"]}
    for x in told:
        if x["docs"] is None and x["dropped"] is None:
            same = [e for e in edges if (e["h1"], e["h2"]) == (x["h1"], x["h2"])]
            if sum(e["docs"] for e in same) >= least and not (keep_first and x["first"] and x["part"] == min(e["part"] for e in same)):
                dropped.add((x["doc_id"], x["at"]))
    want = set()
    for _, g in itertools.groupby(rows, key=lambda r: r[0]):
        g = list(g)
        if len({r[2] for r in g}) >= least:
            want |= {(None if r[2] < 0 else r[2], r[4]) for r in g[keep_first:]}
    assert dropped == want


def test_bitmaps_round_trip():
    for n, gone in ((1, []), (1, [0]), (9, [0, 8]), (1000, list(range(3, 900)))):
        bits = line_dedup.unpacked(line_dedup.packed(np.array(gone, np.int64), n), n)
        assert [i for i in range(n) if not bits[i]] == gone


# --- conversations


def turn_digest(role, text):
    return tuple(int(np.uint64(xxhash.xxh64(text.encode(), seed=xxhash.xxh64(role.encode(), seed=s).intdigest()).intdigest()).astype(np.int64)) for s in (42,))


def conversation_rows(seed=1):
    rng = random.Random(seed)
    words = ["Hello.", "no end", "Why?", "", " \t", "long " * 50 + "!", None, "ü. "]
    rows = []
    for c in [*range(0, 60), 105, 106, 233, -7, -10]:
        if c % 13 == 4:
            continue
        for t in range(rng.randrange(1, 9)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", None, ""])
            rows.append((c, None if rng.random() < 0.05 and t == 0 else t, role, rng.choice(words)))
    rows += [(c, t, ("user", "assistant")[t % 2], "Same %d." % t) for c in range(200, 240) for t in range(30)]  # copies that share 30 turns
    rows += [(c, 30, "user", "last %d" % (c % 3)) for c in range(200, 230)]
    rows += [(58, 3, "user", "repeated."), (58, 3, "user", "repeated."), (59, 2, "user", "tie a."), (59, 2, "user", "tie b?"), (59, 2, "assistant", "tie c.")]
    rng.shuffle(rows)
    return rows


def in_order(rows):
    """Rows by conversation, in order of turn (null first), role and digest; nulls are as the caller has put them."""
    by = defaultdict(list)
    for c, t, role, text in rows:
        by[c].append((t, role, text))
    return {c: sorted(x, key=lambda r: (r[0] is not None, r[0] or 0, r[1], turn_digest(r[1], r[2]))) for c, x in by.items()}


# --- 11 prefix trie


def brute_trie(rows):
    by = {c: [(r, t) for _, r, t in x] for c, x in in_order([(c, t, r or "", x or "") for c, t, r, x in rows if c is not None]).items()}
    again = {}
    for c, own in by.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - int(np.fmod(c, 5))
        again[c] = by.get(base, [])[:h] + own[h:]
    members = defaultdict(set)
    for c, turns in again.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].add(c)
    children = defaultdict(set)
    for k in members:
        if k:
            children[k[:-1]].add(k)
    out = []
    for k, m in members.items():
        below = [x for x in members if x[: len(k)] == k]
        ends = sorted(c for c in m if len(again[c]) == len(k))
        saved = sum((len(members[x]) - 1) * len(x[-1][1].encode()) for x in below if x)
        out.append((min(m), len(k), min(members[k[:-1]]) if k else None, len(m), len(children[k]), sum(not children[x] for x in below), saved, sha(",".join(map(str, ends)))))
    return sorted(out, key=str)


CONVERSATIONS = "conv_id long, turn long, role string, text string, depth string, head string, k1 string, n string"


def conversations(spark, rows):
    return spark.createDataFrame([(*r, "a", "b", "c", "d") for r in rows], CONVERSATIONS)


@pytest.mark.parametrize("container", [256, 8, 1])
def test_trie_by_force(spark, container):
    rows = [*conversation_rows(), (None, 1, "user", "of no conversation")]
    got = prefix_trie.conversation_trie(conversations(spark, rows), container).collect()
    assert sorted(map(tuple, got), key=str) == brute_trie(rows)


def test_trie_of_little(spark):
    assert prefix_trie.conversation_trie(conversations(spark, [])).count() == 0
    turnless = [r for r in [(1, 0, "user", "x"), (2, 0, "user", "y")] if zlib.crc32(str(r[0]).encode()) % 9]
    got = prefix_trie.conversation_trie(conversations(spark, turnless)).collect()
    assert sorted(map(tuple, got), key=str) == brute_trie(turnless) and len(got) == 1


def test_long_conversations_in_the_trie(spark):
    rows = [(5 * c, t, "user", f"t{t}" if t < 700 or c == 0 else f"{c} {t}") for c in range(3) for t in range(1000)]
    got = prefix_trie.conversation_trie(conversations(spark, rows), 1)
    top = got.where("depth = 0").first()
    assert (top.n_convs, top.n_leaves) == (3, 3) and got.count() == 1 + 700 + 3 * 300
    assert got.where("depth = 350").first().saved_tokens == 2 * sum(len(f"t{t}") for t in range(349, 700))


def test_ends_over_blocks(spark):
    ids = [*range(-3000, 5000, 7), 2**40]
    members = spark.createDataFrame([(i, 1, 2) for i in ids] + [(9, 3, 4)], "conv_id long, k1 long, k2 long").repartition(7)
    got = {(r.k1, r.k2): r.ends_sha256 for r in prefix_trie.end_digests(members).collect()}
    assert got == {(1, 2): sha(",".join(map(str, ids))), (3, 4): sha("9")}


# --- 13 conversation repair


def brute_edits(symbols):
    """The cheapest edits and of those the least string, by growing all edit strings letter by letter in cost order."""
    best = {}
    todo = [(0, "", 0, "")]  # cost, audit, place, initials given out
    whole = re.compile(r"(s?(ua)+)?")
    fits = re.compile(r"s?(ua)*u?")
    import heapq

    while todo:
        cost, audit, i, given = heapq.heappop(todo)
        tail = given[-1:] if given[-1:] != "" else ""
        if i == len(symbols) and whole.fullmatch(given):
            return cost, audit
        if best.setdefault((i, tail), cost) < cost or len(audit) > 3 * len(symbols) + 4:
            continue
        options = [(3, "I", i, x) for x in "ua"]
        if i < len(symbols):
            role, fault = symbols[i]
            options.append((4, "D", i + 1, ""))
            if fault != "x":
                options += [(3 * (fault == "t"), "K", i + 1, role), *[(3 + 3 * (fault == "t"), "R", i + 1, x) for x in "ua"]]
        for more, letter, j, x in options:
            if fits.fullmatch(given + x):
                heapq.heappush(todo, (cost + more, audit + letter, j, given + x))


def collapsed(symbols):
    return [(k, len(list(g))) for k, g in itertools.groupby(symbols)]


@pytest.mark.parametrize("n", range(6))
def test_least_edits_by_force(n):
    alphabet = [r + f for r in "suao" for f in "-tx"]
    rng = random.Random(n)
    for symbols in itertools.product(alphabet, repeat=n) if n < 3 else [[rng.choice(alphabet) for _ in range(n)] for _ in range(300)]:
        assert least_edits(collapsed(list(symbols))) == brute_edits(list(symbols))


def test_long_runs_by_powers():
    rng = random.Random(2)
    for _ in range(20):
        runs = [(rng.choice("suao") + rng.choice("-tx"), rng.choice([1, 2, 33, 100, 700])) for _ in range(4)]
        singles = [(s, 1) for s, n in runs for _ in range(n)]
        assert least_edits(runs) == least_edits(singles)
    m = power("u-", 0)
    assert power("u-", 3) == times(times(times(m, m), times(m, m)), times(times(m, m), times(m, m)))
    v = (0, 5, 7, 1)
    assert before("a-", 5, v) == before("a-", 2, before("a-", 3, v))
    cost, audit = least_edits([("u-", 200_000)])
    assert cost == 300_000 and audit == "KR" * 100_000


def brute_repair(rows):
    damaged = []
    for c, t, role, text in rows:
        k = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if k:
            row = (c, t, "user" if k == 4 else role, "" if k == 1 else re.sub("[.!?]", "", text) if k == 2 else text)
            damaged += [row] * (2 if k == 3 else 1)
    by, out = in_order(damaged), []
    for c in {r[0] for r in rows}:
        seen, symbols, turns = set(), [], by.get(c, [])
        n = {"b": 0, "d": 0, "t": 0, "-": 0}
        for _, role, text in turns:
            bare = text.strip(BLANKS)
            fault = "b" if not bare else "d" if (role, text) in seen else "t" if bare[-1] not in ".!?" else "-"
            seen.add((role, text))
            n[fault] += 1
            symbols.append((role[:1] if role[:1] in ("s", "u", "a") else "o") + {"b": "x", "d": "x"}.get(fault, fault))
        known = [t for t, _, _ in turns if t is not None]
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(turns))
        cost, audit = brute_edits(symbols) if len(symbols) < 12 else least_edits(collapsed(symbols))
        given, i, repaired = "", 0, []
        for letter in audit:
            role = "assistant" if given[-1:] == "u" else "user"
            if letter == "I":
                repaired.append(f"{role}:")
                given += role[0]
                continue
            _, own, text = turns[i]
            i += 1
            if letter != "D":
                repaired.append(f"{own if letter == 'K' else role}:{text}")
                given += own[0] if letter == "K" else role[0]
        assert i == len(turns) and re.fullmatch(r"(s?(ua)+)?", given)
        out.append((c, gaps, n["b"], n["d"], n["t"], illegal, cost, audit, sha("\n".join(repaired))))
    return sorted(out, key=str)


def test_repair_by_force(spark):
    dropped = next(c for c in range(3000, 4000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    rows = [*conversation_rows(2), (None, 0, "user", "Hm."), (None, None, "assistant", "Well."), (dropped, 0, "user", "gone."), *[(4001, t, "user", "x" * 200_000) for t in range(2)]]
    given = conversations(spark, rows).repartition(5)
    damaged = conversation_repair.damaged(given)
    judged = conversation_repair.judge_conversations(damaged, given)
    digests = {r.conv_id: r.repaired_sha256 for r in conversation_repair.repaired_turns(damaged, judged, digest_only=True).collect()}
    got = sorted([(*r, digests[r.conv_id]) for r in judged.collect()], key=str)
    want = brute_repair(rows)
    assert [x[0] for x in got] == [x[0] for x in want]
    assert got == want
    assert (dropped, 0, 0, 0, 0, 0, 0, "", sha("")) in got
    turns = defaultdict(list)
    for r in conversation_repair.repaired_turns(damaged, judged).collect():
        turns[r.conv_id].append((r.at, r.edit, f"{r.role}:{r.text}"))
    for c, digest in digests.items():
        assert [x[0] for x in sorted(turns[c])] == list(range(len(turns[c])))
        assert sha("\n".join(x[2] for x in sorted(turns[c]))) == digest


def test_repair_of_nothing(spark):
    given = conversations(spark, [])
    judged = conversation_repair.judge_conversations(conversation_repair.damaged(given), given)
    assert judged.count() == 0 and conversation_repair.repaired_turns(conversation_repair.damaged(given), judged).count() == 0
    only = conversations(spark, [(1, 0, None, None)]).select("conv_id", "turn", F.lit("user").alias("role"), F.lit("Hm.").alias("text"))
    assert conversation_repair.judge_conversations(only.limit(0), only).first().audit == ""
