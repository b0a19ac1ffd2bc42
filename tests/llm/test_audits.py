"""Exact dedup by recipes, source audit, conversation repair: edge cases and brute force."""

import collections
import hashlib
import itertools
import random
import re
import zlib

import pytest

from modenorm.llm import chunk_recipes, source_audit, turn_repair


# ---------------------------------------------------------------- exact dedup
def test_chunks_are_the_whole_text():
    rnd = random.Random(4)
    find = re.compile(chunk_recipes.chunk_pattern(8, 40))
    for _ in range(300):
        text = "".join(rnd.choice("ab. \n!漢é😀") for _ in range(rnd.randint(0, 400)))
        chunks = [m.group(0) for m in find.finditer(text)]
        assert "".join(chunks) == text and all(0 < len(c) <= 42 for c in chunks)


def exact_groups(rows):
    groups = collections.defaultdict(list)
    for i, t in rows:
        groups[t or ""].append(i)
    top = {t: max((i for i in ids if i is not None), default=None) for t, ids in groups.items()}
    return sorted((str(i), str(top[t or ""]), len(groups[t or ""]), hashlib.sha256((t or "").encode()).hexdigest())
                  for i, t in rows), len(groups)


@pytest.mark.parametrize("bits", [64, 3])
def test_exact_groups_equal_brute_force(spark, bits):
    """With 3 bits nearly every identifier is shared by different chunks."""
    rnd = random.Random(bits)
    parts = ["alpha beta. " * 9, "gamma\n" * 20, "漢字" * 60, "x" * 3000, "one two three! " * 30]
    texts = ["".join(rnd.choices(parts, k=rnd.randint(1, 4))) for _ in range(60)]
    texts += [t + "." for t in texts[:9]] + [t.upper() for t in texts[:5]] + ["", None, " "]
    rows = [(rnd.randint(0, 500), rnd.choice(texts)) for _ in range(300)] + [(None, texts[0]), (None, "only null ids"), (None, "only null ids")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    out = chunk_recipes.dedupe(df, bits=bits).collect()
    want, n_groups = exact_groups(rows)
    assert sorted((str(r.doc_id), str(r.keep_id), r.group_size, r.text_sha256) for r in out) == want
    assert sum(r.kept for r in out) == n_groups
    assert all(r.doc_id == r.keep_id for r in out if r.kept)


def test_exact_edges(spark):
    rows = [(1, "a", "x"), (1, "a", "y"), (2, None, "z"), (3, "", "z"), (4, "long. " * 200_000, None), (5, "long. " * 200_000, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, recipe string")
    got = sorted((r.doc_id, r.keep_id, r.group_size, r.kept) for r in chunk_recipes.dedupe(df).collect())
    assert got == [(1, 1, 2, False), (1, 1, 2, True), (2, 3, 2, False), (3, 3, 2, True), (4, 5, 2, False), (5, 5, 2, True)]
    assert chunk_recipes.dedupe(df.limit(0)).collect() == []


def test_exact_runs_without_python(spark):
    df = spark.createDataFrame([(1, "a b. c"), (2, "a b. c")], "doc_id long, text string")
    plan = chunk_recipes.dedupe(df)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


# ---------------------------------------------------------------- source audit
def audited(rows, min_docs):
    rows = [tuple(x or "" for x in r) for r in rows]
    n, docs, by_lang = collections.Counter(), collections.Counter(), collections.defaultdict(set)
    for lang, source, text in rows:
        by_lang[lang].add(source)
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m.group().lower(), text))
        for t in terms:
            n[lang, source, t] += 1
            n[lang, None, t] += 1
        for t in set(terms):
            docs[lang, t] += 1
    out = []
    for lang, sources in by_lang.items():
        kept = sorted((t for (x, t), d in docs.items() if x == lang and d >= min_docs), key=str.encode)
        total = {s: sum(n[lang, s, t] for t in kept) for s in [None, *sources]}

        def share(s, t):
            return 1 + 1_000_000_000 * (n[lang, s, t] + 2) // (total[s] + 2 * len(kept))

        for s in sources:
            pair = [(o, sum((share(s, t) - share(o, t)) ** 2 // (share(s, t) + share(o, t)) for t in kept)) for o in sources - {s}]
            term = [(t, (share(s, t) - share(None, t)) ** 2 // (share(s, t) + share(None, t))) for t in kept
                    if n[lang, s, t] and share(s, t) > share(None, t)]
            for part, items in (("pair", pair), ("term", term)):
                items.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, i, v, k) for k, (i, v) in enumerate(items[:None if part == "pair" else 10], 1)]
    return sorted(out)


def audit_rows(n, seed):
    rnd = random.Random(seed)
    words = ["the", "Of", "ÄRA", "ära", "漢字", "x1y", "a_b", "naïve", "THE", "[", "~"] + [f"w{chr(97 + i)}" for i in range(26)]
    rows = [(rnd.choice(["en", "de", None]), rnd.choice(["s", "s", "s", "t", "ü", None]),
             " ".join(rnd.choices(words, k=rnd.randint(0, 30)))) for _ in range(n)]
    return rows + [("en", "empty", None), ("en", "odd", "1 2 3"), ("lone", "one", "word " * 30), ("none", "a", "z"), ("none", "b", None)]


@pytest.mark.parametrize("cells, most", [(1 << 21, 500_000), (40, 20)])
def test_audit_equals_brute_force(spark, monkeypatch, cells, most):
    monkeypatch.setattr(source_audit, "SHARD_CELLS", cells)
    monkeypatch.setattr(source_audit, "TASK_TERMS", most)
    monkeypatch.setattr(source_audit, "SLICE_BYTES", 300)
    rows = audit_rows(250, cells)
    df = spark.createDataFrame([(*r, 1) for r in rows], "lang string, source string, text string, n int").repartition(4)
    got = sorted(tuple(r) for r in source_audit.audit(df, min_docs=5).collect())
    assert got == audited(rows, 5)


def test_audit_edges(spark):
    df = spark.createDataFrame([(None, None, "word " * 400_000), ("x", "b", "word"), ("x", "b", "word")], "lang string, source string, text string")
    assert source_audit.audit(df, min_docs=1).collect() == []          # lone sources; no term above its language
    assert source_audit.audit(df.limit(0)).collect() == []
    two = spark.createDataFrame([("x", "a", None), ("x", "b", "q")], "lang string, source string, text string")
    assert sorted(tuple(r) for r in source_audit.audit(two).collect()) == [("x", "a", "pair", "b", 0, 1), ("x", "b", "pair", "a", 0, 1)]


# ---------------------------------------------------------------- conversation repair
def repaired(rows):
    """(conv, turn, role, text) rows -> {conv: result}; edits found by trying all paths, best first."""
    by = collections.defaultdict(list)
    for conv, turn, role, text in rows:
        key = " " if conv is None else conv, " " if turn is None else turn
        kind = zlib.crc32(f"{key[0]}:{key[1]}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        by[conv] += []
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        by[conv] += [(turn, role, text)] * (2 if kind == 3 else 1)
    out = {}
    for conv, turns in by.items():
        turns.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(),
                                  hashlib.sha256(f"{len(r[1])}:{r[1]}{r[2]}".encode()).digest()))
        seen, faults = set(), []
        for _, role, text in turns:
            tail = text.rstrip(" \t\n\x0b\f\r")[-1:]
            faults.append("blank" if not tail else "duplicate" if (role, text) in seen else "" if tail in ".!?" else "truncated")
            seen.add((role, text))
        known = [t for t, _, _ in turns if t is not None]
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(turns))
        cost, audit, text = search(turns, faults)
        out[conv] = (gaps, faults.count("blank"), faults.count("duplicate"), faults.count("truncated"), illegal, cost, audit,
                     hashlib.sha256(text.encode()).hexdigest())
    return out


def search(turns, faults):
    """Least (cost, edits) by a plain table over whole prefixes: state -> (cost, edits, repaired turns)."""
    follows = {"": "su", "s": "u", "u": "a", "a": "u"}

    def better(table, state, new):
        if state not in table or new[:2] < table[state][:2]:
            table[state] = new

    def with_inserts(table):
        for _ in range(3):
            for state, (c, e, r) in list(table.items()):
                role = "assistant" if state == "u" else "user"
                better(table, role[0], (c + 3, e + "I", r + [role + ":"]))
        return table

    table = {"": (0, "", [])}
    for (_, role, text), fault in zip(turns, faults):
        new = {}
        for state, (c, e, r) in with_inserts(table).items():
            better(new, state, (c + 4, e + "D", r))
            if fault in ("blank", "duplicate"):
                continue
            extra = 3 if fault == "truncated" else 0
            if role[:1] and role[:1] in follows[state]:
                better(new, role[0], (c + extra, e + "K", r + [role + ":" + text]))
            for to in ("user", "assistant"):
                if to[0] in follows[state]:
                    better(new, to[0], (c + 3 + extra, e + "R", r + [to + ":" + text]))
        table = new
    table = with_inserts(table)
    cost, audit, rest = min(table[s] for s in ("", "a") if s in table)
    return cost, audit, "\n".join(rest)


def conversations(seed, many=120):
    rnd = random.Random(seed)
    texts = ["Yes.", "No", "Why?", " ", "", "ok!  ", "cut off", "two\nlines.", "漢字", None]
    rows = []
    for conv in [*range(many), None]:
        for turn in range(rnd.choice([1, 2, 3, 5, 8, 13])):
            if rnd.random() < 0.9:
                rows.append((conv, None if rnd.random() < 0.05 else turn,
                             rnd.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None]), rnd.choice(texts)))
    rows += [(500, k, "user", "again and again") for k in range(700)] + [(501, 3, "user", "same turn.")] * 50
    rows += [(502, k, ["user", "assistant"][k % 2], f"turn {k}.") for k in range(300)]
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_repair_equals_brute_force(spark, seed):
    rows = conversations(seed)
    df = spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, copies string").repartition(6)
    got = {r.conv_id: tuple(r)[1:] for r in turn_repair.repair(df).collect()}
    want = repaired(rows)
    assert got.keys() == want.keys()
    assert [c for c in want if got[c] != want[c]] == []


def test_a_conversation_over_many_partitions(spark):
    rows = [(7, k, "user" if k % 3 else "assistant", f"t{k % 50}.") for k in range(4000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(6)
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(key, "false")
    try:
        assert turn_repair.runs(turn_repair.symbols(turn_repair._marked(turn_repair.damaged(df)))).count() > 1
        assert [tuple(r)[1:] for r in turn_repair.repair(df).collect()] == [repaired(rows)[7]]
    finally:
        spark.conf.unset(key)


def test_binary_powers_equal_single_turns():
    fix = turn_repair.Repairer()
    rnd = random.Random(3)
    for _ in range(200):
        syms = [rnd.randrange(16) for _ in range(rnd.randint(0, 5))]
        lens = [rnd.choice([1, 1, 2, 3, 7, 40]) for _ in syms]
        flat = [s for s, n in zip(syms, lens) for _ in range(n)]
        assert fix.solve(syms, lens) == fix.solve(flat, [1] * len(flat))
    cost, audit = fix.solve([1], [100_000])
    assert (cost, audit) == (150_000, "KR" * 50_000)


def test_repair_edges(spark):
    schema = "conv_id long, turn long, role string, text string"
    assert turn_repair.repair(spark.createDataFrame([], schema)).collect() == []
    dropped = [k for k in range(400) if zlib.crc32(f"{k}:0".encode()) % 20 == 0][:3]
    plain = next(k for k in range(400) if zlib.crc32(f"{k}:0".encode()) % 20 > 4)
    rows = [(k, 0, "user", "gone.") for k in dropped] + [(plain, 0, "user", "long text. " * 100_000)]
    got = {r.conv_id: r for r in turn_repair.repair(spark.createDataFrame(rows, schema)).collect()}
    assert all(tuple(got[k])[1:] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) for k in dropped)
    assert (got[plain].cost, got[plain].audit) == (3, "KI")
