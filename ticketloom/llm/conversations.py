"""Structure repair of conversations.

A conversation's rows become a shape whose role initials read ``(s?(ua)+)?`` by the cheapest edits:
Keep 0, Rerole to user or assistant 1, Delete 2, Insert of an empty message 5, and 5 more for a
truncated row that stays.  The search is a shortest path in a DAG whose nodes are (rows read, state)
and whose weights are single integers.  The high digits of a weight carry cost; below them lie
positional octal digits of a fixed width, one for each edit made so far, in ASCII order of the edits'
initials and with zeros after the last.  So an ordinary integer minimum settles cost first and then
the ASCII-least audit.  (Of two paths into one node with one cost, neither audit can be a prefix of
the other: the letters after it would all be inserts, and cost more.)

Spark damages, flags, shuffles and sorts the rows; a task then reads each conversation once, in
order, and holds the rows on which its paths still differ: what all live paths share is settled
and leaves the integers."""

from __future__ import annotations

import hashlib
from collections import deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ticketloom.llm.common import documents, prepare

BLANKS = " \t\n\x0b\x0c\r"
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5      # costs of edits, and of a truncated row that stays
LETTERS = " DIKR"                                   # a digit's letter; zero pads the end
WIDTH = 96                                          # digits of a weight at first
EMPTY, SYSTEM, USER, ASSISTANT = range(4)           # what the repaired messages end in so far
EXPECTED = {EMPTY: "user", SYSTEM: "user", USER: "assistant", ASSISTANT: "user"}
#: A state is left when another's cost plus this is less: its rest of the way costs at most so much more.
DETOUR = {(EMPTY, ASSISTANT): 2, (EMPTY, USER): 7, (EMPTY, SYSTEM): 10, (SYSTEM, ASSISTANT): 0, (SYSTEM, USER): 5}
REPORT = ("conv_id bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, "
          "cost bigint, audit string, repaired_sha256 string")
MESSAGES = "conv_id bigint, place bigint, edit string, turn bigint, role string, text string"


def read_conversations(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                       text_col: str = "text") -> DataFrame:
    """``(conv_id, turn, role, text, present)``: the columns by these names, all rows present."""
    return df.select(F.col(conv_col).cast("bigint").alias("conv_id"), F.col(turn_col).cast("bigint").alias("turn"),
                     F.col(role_col).cast("string").alias("role"), F.col(text_col).cast("string").alias("text"),
                     F.lit(True).alias("present"))


def damage(rows: DataFrame) -> DataFrame:
    """Rows of ``read_conversations`` with the test damage that crc32(``conv_id:turn``) mod 20 names: 0 drops
    the row (it stays with ``present`` false and no text), 1 empties its text, 2 removes ``[.!?]`` from it,
    3 repeats the row, 4 sets its role to user.  A null counts as one space, also in the key; ``conv_id``
    and ``turn`` themselves stay null."""
    word = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(word("conv_id"), F.lit(":"), word("turn")).cast("binary")) % 20
    rows = rows.select("conv_id", "turn", word("role").alias("role"), word("text").alias("text"), kind.alias("kind"))
    text = (F.when(F.col("kind").isin(0, 1), F.lit("")).when(F.col("kind") == 2, F.translate("text", ".!?", ""))
            .otherwise(F.col("text")))
    return rows.select("conv_id", "turn", F.when(F.col("kind") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
                       text.alias("text"), (F.col("kind") != 0).alias("present"),
                       F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy")
                       ).drop("copy")


def ordered(rows: DataFrame) -> DataFrame:
    """The rows by conversation, in order of turn (nulls first), role and text, with their faults.

    One shuffle, by ``conv_id``; both sorts spill.  ``fault`` is the first that holds: ``blank``, ``duplicate``
    (role and text seen earlier), ``truncated`` (the last character that is no blank is none of ``.!?``)."""
    word = lambda c: F.coalesce(F.col(c), F.lit(" "))
    rows = (rows.select("conv_id", "turn", word("role").alias("role"), word("text").alias("text"), "present")
            .withColumn("digest", F.sha2("text", 256)).repartition("conv_id"))
    seen = Window.partitionBy("conv_id", "present", "role", "digest").orderBy(F.col("turn").asc_nulls_first())
    shown = F.rtrim("text", F.lit(BLANKS))
    return (rows.withColumn("seen", F.row_number().over(seen))
            .withColumn("fault", F.when(shown == "", "blank").when(F.col("seen") > 1, "duplicate")
                        .when(~F.right(shown, F.lit(1)).isin(".", "!", "?"), "truncated").otherwise(""))
            .select("conv_id", "turn", "role", "text", "present", "fault")
            .sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "role", "text"))


class Repair:
    """One conversation: ``add`` its rows in order, then ``close``.  Repaired messages come out as soon as all
    paths agree on them, through ``emit(edit, turn, role, text)`` (for a deleted row, the row)."""

    def __init__(self, emit):
        self.emit, self.width = emit, WIDTH
        self.paths = {EMPTY: (0, 0)}           # state: (weight, letters used)
        self.settled = 0                       # cost that all paths have and that left the weights
        self.rows, self.state, self.audit = deque(), EMPTY, []

    def _edge(self, path, cost, digit):
        weight, used = path
        return weight + (cost << 3 * self.width) + (digit << 3 * (self.width - 1 - used)), used + 1

    def _inserts(self):
        paths = dict(self.paths)
        into = [self._edge(paths[s], INSERT, 2) for s in (EMPTY, SYSTEM, ASSISTANT) if s in paths]
        paths[USER] = min(into + [paths[USER]] if USER in paths else into)
        closed = self._edge(paths[USER], INSERT, 2)
        paths[ASSISTANT] = min(closed, paths[ASSISTANT]) if ASSISTANT in paths else closed
        return paths

    def add(self, turn, role, text, fault):
        if max(used for _, used in self.paths.values()) + 4 > self.width:
            self._settle()
        initial, paths, after = role[:1], self._inserts(), {}
        must_go = fault in ("blank", "duplicate")
        self.rows.append((turn, role, None if must_go else text))
        extra = TRUNCATED if fault == "truncated" else 0
        for state, path in paths.items():
            steps = [(state, DELETE, 1)]
            if not must_go:
                steps.append((USER if state != USER else ASSISTANT, REROLE + extra, 4))
                if initial == "s" and state == EMPTY:
                    steps.append((SYSTEM, extra, 3))
                elif initial == ("a" if state == USER else "u"):
                    steps.append((ASSISTANT if state == USER else USER, extra, 3))
            for target, cost, digit in steps:
                new = self._edge(path, cost, digit)
                if target not in after or new < after[target]:
                    after[target] = new
        cost = {s: w >> 3 * self.width for s, (w, _) in after.items()}
        self.paths = {s: p for s, p in after.items()
                      if not any(s == a and b in cost and cost[s] > cost[b] + more for (a, b), more in DETOUR.items())}

    def _settle(self):
        """Give out the leading letters that all paths share; make room for more if there are few."""
        low = (1 << 3 * self.width) - 1
        digits = [w & low for w, _ in self.paths.values()]
        apart = 0
        for d in digits:
            apart |= d ^ digits[0]
        shared = min([(3 * self.width - apart.bit_length()) // 3] + [used for _, used in self.paths.values()])
        weight, _ = next(iter(self.paths.values()))
        self._give((weight & low) >> 3 * (self.width - shared), shared)
        base = min(w >> 3 * self.width for w, _ in self.paths.values())
        self.settled += base
        wider = 0 if 2 * shared > self.width else self.width
        self.paths = {s: ((((w >> 3 * self.width) - base) << 3 * (self.width + wider))
                          | (((w & low) << 3 * shared & low) << 3 * wider), used - shared)
                      for s, (w, used) in self.paths.items()}
        self.width += wider

    def _give(self, number, count):
        """Carry out ``count`` letters, the octal digits of ``number``."""
        letters = "".join(LETTERS[int(c)] for c in format(number, "o").zfill(count)) if count else ""
        for letter in letters:
            turn, role, text = (None, EXPECTED[self.state], "") if letter == "I" else self.rows.popleft()
            if letter == "R":
                role = EXPECTED[self.state]
            if letter != "D":
                self.state = SYSTEM if letter == "K" and role[:1] == "s" else ASSISTANT if self.state == USER else USER
            self.emit(letter, turn, role, text)
        self.audit.append(letters)

    def close(self):
        """``(cost, audit)`` of the whole conversation."""
        paths = self._inserts()
        weight, used = min(paths[s] for s in (EMPTY, ASSISTANT) if s in paths)
        self._give((weight & ((1 << 3 * self.width) - 1)) >> 3 * (self.width - used), used)
        return self.settled + (weight >> 3 * self.width), "".join(self.audit)


class Report:
    """Counts of one conversation's rows, and the hash of its repaired messages."""

    def __init__(self):
        self.low = self.high = self.last = None
        self.turns = self.illegal = self.messages = 0
        self.faults = {"blank": 0, "duplicate": 0, "truncated": 0, "": 0}
        self.before, self.hash = None, hashlib.sha256()
        self.repair = Repair(self.message)

    def row(self, turn, role, text, fault):
        self.faults[fault] += 1
        if turn is not None:
            self.low = turn if self.low is None else self.low
            self.turns += turn != self.high
            self.high = turn
        self.illegal += self.before is not None and self.before + role[:1] not in ("su", "ua", "au")
        self.before = role[:1]
        self.repair.add(turn, role, text, fault)

    def message(self, edit, turn, role, text):
        if edit != "D":
            self.hash.update(("\n" if self.messages else "").encode() + f"{role}:{text}".encode())
            self.messages += 1

    def close(self):
        cost, audit = self.repair.close()
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return (min(gaps, 2 ** 63 - 1), self.faults["blank"], self.faults["duplicate"], self.faults["truncated"],
                self.illegal, cost, audit, self.hash.hexdigest())


def _conversations(batches: Iterator) -> Iterator:
    """``(conv_id, row)`` of sorted batches, few rows at a time as Python objects."""
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256).to_pydict()
            yield from zip(part["conv_id"], zip(part["turn"], part["role"], part["text"], part["fault"]), part["present"])


def _reports(batches):
    schema = pa.schema([("conv_id", pa.int64()), *((c, pa.int64()) for c in (
        "gaps", "blank", "duplicate", "truncated", "illegal", "cost")), ("audit", pa.string()), ("repaired_sha256", pa.string())])
    done, now, report, size = [], None, None, 0
    pack = lambda rows: pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in rows], schema=schema)
    for conv, row, present in _conversations(batches):
        if report is None or conv != now:
            if report is not None:
                done.append((now, *report.close()))
                size += len(done[-1][7])
            if len(done) >= 4096 or size > 1 << 22:
                yield pack(done)
                done, size = [], 0
            now, report = conv, Report()
        if present:
            report.row(*row)
    if report is not None:
        yield pack(done + [(now, *report.close())])


def _messages(batches):
    schema = pa.schema([("conv_id", pa.int64()), ("place", pa.int64()), ("edit", pa.string()), ("turn", pa.int64()),
                        ("role", pa.string()), ("text", pa.string())])
    out, now, repair, place = [], None, None, 0
    pack = lambda: pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in out], schema=schema)

    def emit(edit, turn, role, text):
        nonlocal place
        if edit != "D":
            out.append((now, place, edit, turn, role, text))
            place += 1
    for conv, row, present in _conversations(batches):
        if repair is None or conv != now:
            if repair is not None:
                repair.close()
            if len(out) >= 256:
                yield pack()
                out.clear()
            now, repair, place = conv, Repair(emit), 0
        if present:
            repair.add(*row)
        if len(out) >= 256:
            yield pack()
            out.clear()
    if repair is not None:
        repair.close()
        yield pack()


def repaired_messages(rows: DataFrame) -> DataFrame:
    """``(conv_id, place, edit, turn, role, text)``: the messages of each repaired conversation, in order of
    ``place`` from 0; ``edit`` is K, R or I (an inserted message has no turn and an empty text)."""
    prepare(rows.sparkSession)
    return ordered(rows).mapInArrow(_messages, MESSAGES)


def repair_report(rows: DataFrame) -> DataFrame:
    """One row for each ``conv_id`` (null is one) of ``(conv_id, turn, role, text, present)`` rows: turn ``gaps``,
    rows by first fault, ``illegal`` neighbours, ``cost`` and ``audit`` of the repair, and the SHA-256 of
    the repaired ``role:text`` lines.

    Rows that are not present only name their conversation; one with no others has zeros, an empty audit
    and the hash of nothing.  Nulls in role and text count as one space, so a null text is blank; rows
    of one turn follow each other by role and text, so repeated rows are neighbours and all but the
    first are duplicates.  Extra columns are ignored, texts of any length are read whole, and an
    empty table gives no rows.  A conversation is read by one task in order, as its hash needs; the
    task holds the audit and the rows on which paths still differ."""
    prepare(rows.sparkSession)
    return ordered(rows).mapInArrow(_reports, REPORT)


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Damages all of ``conversations`` and repairs each; one row per original ``conv_id``."""
    return repair_report(damage(read_conversations(documents(spark, sf_dir, "conversations"))))


def _oracle() -> str:
    """DuckDB SQL: the same shortest path as a recursive query that keeps, for each state, the least
    ``{cost, audit, repaired text}``."""
    step = lambda s, cost, letter, said="": (
        f"CASE WHEN {s} IS NULL THEN NULL ELSE {{'c': {s}.c + {cost}, 'a': {s}.a || '{letter}', 't': {s}.t{said}}} END")
    said = lambda role, text: f" || chr(10) || {role} || ':' || {text}"
    insert = lambda s, role: step(s, 5, "I", said(f"'{role}'", "''"))
    may = lambda cond, x: f"CASE WHEN {cond} THEN {x} END"
    keep = lambda s, ini: may(f"NOT must AND ini = '{ini}'", step(s, "extra", "K", said("role", "text")))
    rerole = lambda s, role: may("NOT must", step(s, "1 + extra", "R", said(f"'{role}'", "text")))
    delete = lambda s: step(s, 2, "D")
    to_user = ", ".join(f(s, x) for s in ("e", "s", "x") for f, x in ((keep, "u"), (rerole, "user")))
    gap = (f"SELECT *, least(x0, {insert('u', 'assistant')}) AS x FROM (SELECT * EXCLUDE (u0), "
           f"least(u0, {insert('e', 'user')}, {insert('s', 'user')}, {insert('x0', 'user')}) AS u FROM (%s))")
    crc = ("xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(range(strlen(k)), lambda i: "
           "list_prepend(('0x' || substr(hex(encode(k)), 2 * i + 1, 2))::BIGINT, [-1, -1, -1, -1, -1, -1, -1, -1])))), "
           "lambda c, b: CASE WHEN b >= 0 THEN xor(c, b) ELSE xor(c >> 1, (c & 1) * 3988292384) END), 4294967295)")
    shape = "STRUCT(c BIGINT, a VARCHAR, t VARCHAR)"
    start = f"{{'c': 0::BIGINT, 'a': '', 't': ''}}::{shape}"
    return f"""
WITH RECURSIVE keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k FROM conversations),
kinds AS (SELECT * EXCLUDE (k), {crc} % 20 AS kind FROM keyed),
damaged AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM (SELECT *, unnest(range(CASE WHEN kind = 3 THEN 2 ELSE 1 END)) AS copy FROM kinds) WHERE kind <> 0),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos, left(role, 1) AS ini,
         rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS shown FROM damaged),
faults AS (
  SELECT *, lag(ini) OVER (PARTITION BY conv_id ORDER BY pos) AS before,
         CASE WHEN shown = '' THEN 'blank'
              WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) > 1 THEN 'duplicate'
              WHEN right(shown, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault FROM placed),
rows_ AS (SELECT *, fault IN ('blank', 'duplicate') AS must, CASE WHEN fault = 'truncated' THEN 5 ELSE 0 END AS extra FROM faults),
counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
         count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (before IS NOT NULL AND before || ini NOT IN ('su', 'ua', 'au')) AS illegal, max(pos) AS n
  FROM rows_ GROUP BY conv_id),
paths AS (
  SELECT conv_id, 0::BIGINT AS pos, {start} AS e, NULL::{shape} AS s, NULL::{shape} AS u0, NULL::{shape} AS x0
  FROM counts
  UNION ALL
  SELECT conv_id, pos, {delete('e')}, least({delete('s')}, {keep('e', 's')}), least({delete('u')}, {to_user}),
         least({delete('x')}, {keep('u', 'a')}, {rerole('u', 'assistant')})
  FROM ({gap % "SELECT p.conv_id, r.pos, r.role, r.text, r.ini, r.must, r.extra, p.e, p.s, p.u0, p.x0 FROM paths p "
        "JOIN rows_ r ON r.conv_id IS NOT DISTINCT FROM p.conv_id AND r.pos = p.pos + 1"})),
ends AS (
  SELECT conv_id, least(e, x) AS best FROM ({gap % "SELECT p.* FROM paths p JOIN counts c ON c.conv_id IS NOT DISTINCT FROM p.conv_id AND c.n = p.pos"}))
SELECT a.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(best.c, 0) AS cost,
       coalesce(best.a, '') AS audit, sha256(coalesce(substr(best.t, 2), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) a
LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM a.conv_id
LEFT JOIN ends d ON d.conv_id IS NOT DISTINCT FROM a.conv_id"""


ORACLE = _oracle()
