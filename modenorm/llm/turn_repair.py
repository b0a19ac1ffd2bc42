"""Conversations damaged by a fixed rule, and their cheapest repair by a run-length dynamic program.

A turn is a symbol: the class of its role's initial (s, u, a, other) and its fault (none, truncated, to delete).
Four states say what the repaired turns so far end in: nothing, ``s``, ``u``, ``a``.  Inserting, then keeping,
reroling or deleting one turn moves between states at a cost, so a symbol is a 4 x 4 min-plus matrix.  Equal
consecutive symbols are one run; a run of length k takes the matrix to the power k, put together from cached binary
powers.  Entries hold their edits beside the cost, (cost, text of initials), and the least pair wins: with equal
numbers of turns no text of edits of one cost begins another, so the least entry of a product is the product of least
entries.  Costs to go run backward over the runs; the choices are then unrolled forward, run by run.

On Spark: damage and faults are SQL expressions.  Narrow rows (no texts) of equal content are added up before any
exchange; a turn is a duplicate unless it is at the first turn with its role and text, which an aggregate and a join
find.  The narrow rows are range-partitioned by (conversation, turn), so that a conversation of any size is cut over
many tasks, and collapse to runs there.  Texts move once, by conversation, together with the runs; one streaming pass
solves each conversation when its runs are read and then hashes its texts one by one.  A task holds the runs and the
audit of one conversation, which is one value of its result row, never its texts; SHA-256 itself is sequential.

Defined results: rows with a null ``conv_id`` are one conversation.  Rows of one turn (ties, repeated rows) are taken
by role, then by the SHA-256 of role and text; equal rows are adjacent.  Two roles and texts count as equal when
their SHA-256 are.  An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from modenorm.llm.common import staged, text_batches

# Fixed values of the contract: what an edit costs.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3

_BLANKS = r" \t\n\x0B\f\r"
RESULT = ("conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
          "repaired_sha256 string")


def damaged(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
            text_col: str = "text") -> DataFrame:
    """``conv_id, turn, role, text, copies`` after damage; a dropped row has 0 copies, a repeated one 2."""
    kind = "crc32(encode(concat(coalesce(CAST(conv_id AS STRING), ' '), ':', coalesce(CAST(turn AS STRING), ' ')), 'UTF-8')) % 20"
    rows = df.select(F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).cast("long").alias("turn"),
                     *[F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(n) for c, n in ((role_col, "role"), (text_col, "text"))])
    return rows.withColumn("kind", F.expr(kind)).selectExpr(
        "conv_id", "turn", "IF(kind = 4, 'user', role) AS role",
        "CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '') ELSE text END AS text",
        "CASE kind WHEN 0 THEN 0L WHEN 3 THEN 2L ELSE 1L END AS copies")


def _marked(rows: DataFrame) -> DataFrame:
    """``rows`` with the identity of role and text, and the role's class."""
    return (rows.withColumn("same", F.expr("unhex(sha2(concat(char_length(role), ':', role, text), 256))"))
            .withColumn("cls", F.expr("CASE left(role, 1) WHEN 's' THEN 0 WHEN 'u' THEN 1 WHEN 'a' THEN 2 ELSE 3 END")))


def symbols(marked: DataFrame) -> DataFrame:
    """``conv_id, turn, role, same, cls, fault, n``: narrow rows, equal ones added up; fault 0 none, 1 truncated,
    2 duplicate, 3 blank.  A dropped row has n 0."""
    ends = marked.withColumn("tail", F.expr(f"right(rtrim('{_BLANKS}', text), 1)"))
    flat = ends.selectExpr("conv_id", "turn", "IF(copies = 0, '', role) AS role", "IF(copies = 0, X'', same) AS same", "cls",
                           "copies", "CASE WHEN tail = '' THEN 3 WHEN tail IN ('.', '!', '?') THEN 0 ELSE 1 END AS own")
    flat = (flat.withColumn("cls", F.expr("IF(copies = 0, 3, cls)")).withColumn("own", F.expr("IF(copies = 0, 3, own)"))
            .groupBy("conv_id", "turn", "role", "same", "cls", "own").agg(F.sum("copies").alias("n")))
    first = flat.where("n > 0").groupBy("conv_id", "same").agg(
        F.min(F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn"))).alias("first"))
    both = flat.alias("f").join(first.alias("g"), F.col("f.conv_id").eqNullSafe(F.col("g.conv_id"))
                                & (F.col("f.same") == F.col("g.same")), "left")
    both = both.selectExpr("f.*", "f.turn <=> first.turn AS at_first")
    # of equal rows at their first turn one has its own fault, all others are duplicates
    return both.selectExpr(
        "conv_id", "turn", "role", "same", "cls",
        "inline(CASE WHEN n = 0 OR own = 3 THEN array(struct(0 AS part, 3 AS fault, n AS n)) "
        "WHEN NOT at_first THEN array(struct(0 AS part, 2 AS fault, n AS n)) "
        "WHEN n = 1 THEN array(struct(0 AS part, own AS fault, n AS n)) "
        "ELSE array(struct(0 AS part, own AS fault, 1L AS n), struct(1 AS part, 2 AS fault, n - 1 AS n)) END)")


def runs(rows: DataFrame) -> DataFrame:
    """``conv_id, place, syms, lens, first, last, turns`` of each conversation's part in each range partition."""
    ordered = (rows.repartitionByRange("conv_id", "turn", "role", "same")
               .sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "role", "same", "part")
               .withColumn("place", F.monotonically_increasing_id())
               .select("conv_id", "place", "turn", "cls", "fault", "n"))

    def collapse(batches):
        import pyarrow as pa

        names = ["conv_id", "place", "syms", "lens", "first", "last", "turns"]
        types = [pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.int64(), pa.int64(), pa.int64()]
        done, now = [], None

        def flush():
            out = pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*done), types)], names=names)
            done.clear()
            return out

        for batch in batches:
            for conv, place, turn, cls, fault, n in zip(*(c.to_pylist() for c in batch.columns)):
                if now is None or now[0] != conv:
                    if now is not None:
                        done.append(now)
                        if len(done) >= 5000:
                            yield flush()
                    now = [conv, place, [], [], None, None, 0]
                if n:
                    sym = 4 * fault + cls
                    if now[2] and now[2][-1] == sym:
                        now[3][-1] += n
                    else:
                        now[2].append(sym)
                        now[3].append(n)
                    if turn is not None and turn != now[5]:
                        now[4] = turn if now[4] is None else now[4]
                        now[5] = turn
                        now[6] += 1
        if now is not None:
            done.append(now)
            yield flush()

    return ordered.mapInArrow(collapse, "conv_id long, place long, syms array<int>, lens array<long>, first long, last long, turns long")


class Repairer:
    """Cheapest edits of a run-length list of symbols; the binary powers of every symbol met are kept."""

    #: powers up to 2 ** KEPT turns stay in memory
    KEPT = 12
    #: after all turns: cost and edits from each state to an accepted end
    END = [(0, ""), (2 * INSERT, "II"), (INSERT, "I"), (0, "")]

    def __init__(self):
        self.powers = {}

    @staticmethod
    def step(sym):
        """Matrix of one turn: entry [i][j] is (cost, edits) from state i to state j, or None."""
        fault, cls = divmod(sym, 4)
        wants = [(0, 1), (1,), (2,), (1,)]                      # classes that may come next
        reach = [[(0, 0), (2, 1), (3, 2)], [(1, 0), (2, 1), (3, 2)], [(2, 0), (3, 1)], [(3, 0), (2, 1)]]
        out = [[None] * 4 for _ in range(4)]
        for i in range(4):
            for m, inserted in reach[i]:
                moves = [(m, DELETE, "D")]
                if fault < 2:
                    kept = TRUNCATED * fault
                    if cls in wants[m]:
                        moves.append((cls + 1, kept, "K"))
                    moves.append((3 if m == 2 else 2, kept + REROLE, "R"))
                for j, cost, edit in moves:
                    new = (INSERT * inserted + cost, "I" * inserted + edit)
                    if out[i][j] is None or new < out[i][j]:
                        out[i][j] = new
        return out

    @staticmethod
    def times(a, b):
        out = []
        for i in range(4):
            row = []
            for j in range(4):
                ways = [(a[i][m][0] + b[m][j][0], a[i][m][1] + b[m][j][1]) for m in range(4) if a[i][m] and b[m][j]]
                row.append(min(ways) if ways else None)
            out.append(row)
        return out

    def power(self, sym, bit):
        """The matrix of 2 ** bit equal turns."""
        if (sym, bit) in self.powers:
            return self.powers[sym, bit]
        half = self.power(sym, bit - 1) if bit else None
        made = self.times(half, half) if bit else self.step(sym)
        if bit <= self.KEPT:
            self.powers[sym, bit] = made
        return made

    def solve(self, syms, lens):
        """(cost, edits) of the least pair."""
        bits = [[b for b in range(n.bit_length()) if n >> b & 1] for n in lens]
        costs = [[c for c, _ in self.END]]
        for sym, own in zip(reversed(syms), reversed(bits)):
            to_go = costs[-1]
            for b in own:
                m = self.power(sym, b)
                to_go = [min(e[0] + to_go[j] for j, e in enumerate(row) if e) for row in m]
            costs.append(to_go)
        costs.reverse()
        state, text = 0, []
        for k, (sym, own) in enumerate(zip(syms, bits)):
            at = [None] * 4
            at[state] = (0, "")
            for b in own:
                m = self.power(sym, b)
                at = [min(((e[0] + m[i][j][0], e[1] + m[i][j][1]) for i, e in enumerate(at) if e and m[i][j]), default=None)
                      for j in range(4)]
            edits, state = min((e[1], j) for j, e in enumerate(at) if e and e[0] + costs[k + 1][j] == costs[k][state])
            text.append(edits)
        return costs[0][0], "".join(text) + self.END[state][1]


def illegal_pairs(syms, lens):
    """Adjacent turns whose roles' initials are not su, ua or au."""
    count, last = 0, None
    for sym, n in zip(syms, lens):
        cls = sym % 4
        count += n - 1 + (last is not None and (last, cls) not in ((0, 1), (1, 2), (2, 1)))
        last = cls
    return count


def _expected(audit):
    """Role of each repaired turn by its place: (has a system turn first, number of turns)."""
    n = len(audit) - audit.count("D")
    return n % 2 == 1


def _repair(batches):
    """Rows of one partition, sorted by conversation: parts of runs first, then texts in order."""
    import hashlib

    import pyarrow as pa

    fix, done = Repairer(), []
    names = [f.split()[0] for f in RESULT.split(", ")]
    types = [pa.int64()] * 7 + [pa.string()] * 2

    def flush():
        out = pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*done), types)], names=names)
        done.clear()
        return out

    class Conversation:
        def __init__(self, conv):
            self.conv, self.syms, self.lens = conv, [], []
            self.first = self.last = None
            self.turns, self.audit = 0, None

        def add(self, syms, lens, first, last, turns):
            for s, n in zip(syms, lens):
                if self.syms and self.syms[-1] == s:
                    self.lens[-1] += n
                else:
                    self.syms.append(s)
                    self.lens.append(n)
            if turns:
                self.turns += turns - (self.last is not None and self.last == first)
                self.first = first if self.first is None else self.first
                self.last = last

        def start(self):
            self.cost, self.audit = fix.solve(self.syms, self.lens)
            self.system, self.at, self.out, self.hash = _expected(self.audit), 0, 0, hashlib.sha256()

        def put(self, role, text):
            if role is None:
                role = "assistant" if (self.out - self.system) % 2 else "user"
            self.hash.update((("\n" if self.out else "") + role + ":" + text).encode())
            self.out += 1

        def inserts(self):
            while self.at < len(self.audit) and self.audit[self.at] == "I":
                self.put(None, "")
                self.at += 1

        def turn(self, role, text):
            self.inserts()
            edit = self.audit[self.at]
            self.at += 1
            if edit != "D":
                self.put(role if edit == "K" else None, text)

        def result(self):
            if self.audit is None:
                self.start()
            self.inserts()
            faults = [sum(n for s, n in zip(self.syms, self.lens) if s // 4 == f) for f in (3, 2, 1)]
            gaps = 0 if self.first is None else self.last - self.first + 1 - self.turns
            return (self.conv, gaps, *faults, illegal_pairs(self.syms, self.lens), self.cost, self.audit, self.hash.hexdigest())

    now = None
    for batch in batches:
        for conv, is_text, role, text, copies, syms, lens, first, last, turns in zip(*(c.to_pylist() for c in batch.columns)):
            if now is None or now.conv != conv:
                if now is not None:
                    done.append(now.result())
                    if len(done) >= 2000:
                        yield flush()
                now = Conversation(conv)
            if not is_text:
                now.add(syms, lens, first, last, turns)
                continue
            if now.audit is None:
                now.start()
            for _ in range(copies):
                now.turn(role, text)
    if now is not None:
        done.append(now.result())
        yield flush()


def repair(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text") -> DataFrame:
    """One row per conversation: its gaps, faults, cheapest edits and the hash of what they give."""
    text_batches(df.sparkSession)
    rows = _marked(damaged(df, conv_col, turn_col, role_col, text_col))
    parts = staged(df.sparkSession, runs(symbols(rows)), "turn-runs")
    texts = rows.where("copies > 0").selectExpr(
        "conv_id", "true AS is_text", "turn", "same", "0L AS place", "role", "text", "copies",
        "CAST(NULL AS ARRAY<INT>) AS syms", "CAST(NULL AS ARRAY<LONG>) AS lens", "0L AS first", "0L AS last", "0L AS turns")
    lists = parts.selectExpr(
        "conv_id", "false AS is_text", "CAST(NULL AS LONG) AS turn", "X'' AS same", "place", "'' AS role", "'' AS text", "0L AS copies",
        "syms", "lens", "first", "last", "turns")
    dealt = texts.unionByName(lists).repartition("conv_id").sortWithinPartitions(
        "conv_id", "is_text", "place", F.col("turn").asc_nulls_first(), "role", "same")
    return dealt.select("conv_id", "is_text", "role", "text", "copies", "syms", "lens", "first", "last", "turns").mapInArrow(_repair, RESULT)


REPAIR_SQL = r"""
WITH RECURSIVE
keyed AS (
  SELECT row_number() OVER () AS row_id, conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         list_transform(string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''),
                        lambda x: CAST(ord(x) AS BIGINT)) AS bytes
  FROM conversations),
crc AS (
  SELECT row_id, xor(list_reduce(list_prepend(4294967295::BIGINT, bytes), lambda c, b:
           list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[], lambda r, z:
             CASE WHEN r % 2 = 1 THEN xor(r // 2, 3988292384::BIGINT) ELSE r // 2 END)), 4294967295::BIGINT) % 20 AS kind
  FROM keyed),
harmed AS (
  SELECT row_id, conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, copy
  FROM keyed JOIN crc USING (row_id), LATERAL (SELECT unnest(range(CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy)),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(length(role) || ':' || role || text), row_id, copy) AS k
  FROM harmed),
judged AS (
  SELECT *, left(role, 1) AS initial,
         CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank'
              WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY k) > 1 THEN 'duplicate'
              WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') THEN 'truncated' ELSE '' END AS fault,
         lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY k) AS before
  FROM placed),
ids AS (SELECT DISTINCT conv_id FROM conversations),
totals AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
         count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n
  FROM judged GROUP BY conv_id),
inserts(old, mid, pay, mark) AS (VALUES (0, 0, 0, ''), (0, 2, 3, 'I'), (0, 3, 6, 'II'), (1, 1, 0, ''), (1, 2, 3, 'I'), (1, 3, 6, 'II'),
                                  (2, 2, 0, ''), (2, 3, 3, 'I'), (3, 3, 0, ''), (3, 2, 3, 'I')),
keeps(mid, initial, new) AS (VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2)),
moves AS (
  SELECT conv_id, k, old, mid AS new, pay + 4 AS pay, mark || 'D' AS mark FROM judged, inserts
  UNION ALL
  SELECT conv_id, k, old, new, pay + CASE fault WHEN 'truncated' THEN 3 ELSE 0 END, mark || 'K'
  FROM judged JOIN keeps USING (initial) JOIN inserts USING (mid) WHERE fault NOT IN ('blank', 'duplicate')
  UNION ALL
  SELECT conv_id, k, old, CASE mid WHEN 2 THEN 3 ELSE 2 END, pay + 3 + CASE fault WHEN 'truncated' THEN 3 ELSE 0 END, mark || 'R'
  FROM judged, inserts WHERE fault NOT IN ('blank', 'duplicate')),
ways(conv_id, k, state, best) AS (
  SELECT conv_id, 0::BIGINT, 0, {'cost': 0::BIGINT, 'audit': ''} FROM ids
  UNION ALL
  SELECT w.conv_id, w.k + 1, m.new, min({'cost': w.best.cost + m.pay, 'audit': w.best.audit || m.mark})
  FROM ways w JOIN moves m ON m.conv_id IS NOT DISTINCT FROM w.conv_id AND m.k = w.k + 1 AND m.old = w.state GROUP BY ALL),
ended AS (
  SELECT w.conv_id, min({'cost': best.cost + e.pay, 'audit': best.audit || e.mark}) AS best
  FROM ways w LEFT JOIN totals t ON t.conv_id IS NOT DISTINCT FROM w.conv_id
  JOIN (VALUES (0, 0, ''), (1, 6, 'II'), (2, 3, 'I'), (3, 0, '')) e(state, pay, mark) ON e.state = w.state
  WHERE w.k = coalesce(t.n, 0) GROUP BY w.conv_id),
edits AS (
  SELECT conv_id, i, edit, count(*) FILTER (edit <> 'I') OVER (PARTITION BY conv_id ORDER BY i) AS k,
         count(*) FILTER (edit <> 'D') OVER (PARTITION BY conv_id ORDER BY i) AS place,
         count(*) FILTER (edit <> 'D') OVER (PARTITION BY conv_id) % 2 AS sys
  FROM (SELECT conv_id, unnest(range(1, length(best.audit) + 1)) AS i, unnest(string_split(best.audit, '')) AS edit FROM ended WHERE best.audit <> '')),
fixed AS (
  SELECT e.conv_id, string_agg(CASE edit WHEN 'K' THEN j.role ELSE CASE (place - 1 - sys) % 2 WHEN 0 THEN 'user' ELSE 'assistant' END END
                               || ':' || CASE edit WHEN 'I' THEN '' ELSE j.text END, chr(10) ORDER BY i) AS text
  FROM edits e LEFT JOIN judged j ON j.conv_id IS NOT DISTINCT FROM e.conv_id AND j.k = e.k
  WHERE edit <> 'D' GROUP BY e.conv_id)
SELECT i.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank,
       CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate, CAST(coalesce(truncated, 0) AS BIGINT) AS truncated,
       CAST(coalesce(illegal, 0) AS BIGINT) AS illegal, CAST(best.cost AS BIGINT) AS cost, best.audit AS audit,
       sha256(coalesce(f.text, '')) AS repaired_sha256
FROM ids i LEFT JOIN totals t ON t.conv_id IS NOT DISTINCT FROM i.conv_id
LEFT JOIN ended e ON e.conv_id IS NOT DISTINCT FROM i.conv_id
LEFT JOIN fixed f ON f.conv_id IS NOT DISTINCT FROM i.conv_id"""
