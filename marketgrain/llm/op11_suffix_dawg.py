"""Conversation structure repair with a suffix-shared automaton.

Every row of a conversation becomes one symbol (role class and fault), so a
conversation is a word, its signature. Minimised from the end, all signatures
together form an acyclic automaton in which equal suffixes are one node. The cost
of the cheapest repair from a node on, and its first edits, depend on the node and
on the state of the grammar alone; they are found once for each and shared by all
conversations that run through it.

Signatures are sorted by their reverse, so those with common ends are neighbours
and each task walks from one to the next along the part that differs. A node is
met again only where a range of the sort ends. Costs are held relative to the
least of a node, which leaves few different nodes to evaluate, and a step is looked
up by (node below, symbol).

Rows move by range of (conversation, turn), so a conversation of any length is cut
over several tasks; only its signature and its audit, a byte a row, are ever held
as one value. The digest of the repaired text streams over sorted rows.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketgrain.llm import common

SPACE = "\x20\x09\x0a\x0b\x0c\x0d"
SOUND, TRUNCATED, BLANK, DUPLICATE = range(4)
INITIALS = "sua"  # any other initial is class 3
START, SYSTEM, USER, ASSISTANT = range(4)  # what the repaired roles so far end with
# the state that a user or an assistant row leads to, whichever the grammar wants next
ENTER = (USER, USER, ASSISTANT, USER)
KEEP = ((SYSTEM, USER, None), (None, USER, None), (None, None, ASSISTANT), (None, USER, None))
REROLE = INSERT = MENDED = 3
DELETE = 4
NEVER = 1 << 40
FIRST = ord("a")


def least(options: list[tuple]) -> list[tuple]:
    """The cheapest (cost, edits, next state) of each state once rows may be inserted."""
    best = list(options)
    for _ in range(3):
        for state, target in enumerate(ENTER):
            cost, edits, after = best[target]
            best[state] = min(best[state], (cost + INSERT, "I" + edits, after))
    return best


class Automaton:
    """Nodes by their relative costs-to-go; ``step`` adds a symbol before a node."""

    def __init__(self):
        self.nodes: dict[tuple, int] = {}
        self.costs: list[tuple] = []
        self.edits: list[list[tuple]] = []  # of the node's first row, by grammar state
        self.steps: dict[tuple[int, int], int] = {}
        never = (NEVER, "", START)
        self.end = self._node(least([(0, "", START), never, never, (0, "", START)]))

    def _node(self, best: list[tuple]) -> int:
        floor = min(cost for cost, _, _ in best)
        key = tuple((cost - floor, edits, after) for cost, edits, after in best)
        if key not in self.nodes:
            self.nodes[key] = len(self.costs)
            self.costs.append(tuple(cost - floor for cost, _, _ in best))
            self.edits.append([(edits, after) for _, edits, after in best])
        return self.nodes[key]

    def step(self, below: int, symbol: int) -> int:
        """The node whose first row is ``symbol`` and whose other rows are ``below``."""
        found = self.steps.get((below, symbol))
        if found is None:
            role, fault = divmod(symbol - FIRST, 4)
            cost, options = self.costs[below], []
            for state in range(4):
                best = (cost[state] + DELETE, "D", state)
                if fault in (SOUND, TRUNCATED):
                    mend = MENDED if fault == TRUNCATED else 0
                    kept = KEEP[state][role] if role < 3 else None
                    if kept is not None:
                        best = min(best, (cost[kept] + mend, "K", kept))
                    best = min(best, (cost[ENTER[state]] + REROLE + mend, "R", ENTER[state]))
                options.append(best)
            found = self.steps[below, symbol] = self._node(least(options))
        return found


class Suffixes:
    """The nodes of one signature's suffixes, kept while the next shares them."""

    def __init__(self):
        self.automaton = Automaton()
        self.word, self.path = b"", array("i", [self.automaton.end])

    def audit(self, signature: bytes) -> str:
        """The cheapest edits that repair a signature, the ASCII-least of equal ones."""
        word = signature[::-1]
        a, b = (np.frombuffer(w, np.uint8)[: min(len(word), len(self.word))] for w in (word, self.word))
        differ = np.flatnonzero(a != b)
        shared = int(differ[0]) if len(differ) else len(a)
        del self.path[shared + 1 :]
        node, step = self.path[-1], self.automaton.step
        for symbol in word[shared:]:
            node = step(node, symbol)
            self.path.append(node)
        self.word = word
        state, out = START, []
        for node in reversed(self.path):
            edits, state = self.automaton.edits[node][state]
            out.append(edits)
        return "".join(out)


def price(audit: str, signature: bytes) -> int:
    """What the edits of an audit cost: its letters, and the truncated rows that stay."""
    rows = np.frombuffer(audit.replace("I", "").encode(), np.uint8)
    truncated = (np.frombuffer(signature, np.uint8) - FIRST) % 4 == TRUNCATED
    mended = int((truncated & (rows != ord("D"))).sum())
    return INSERT * audit.count("I") + REROLE * audit.count("R") + DELETE * audit.count("D") + MENDED * mended


def damaged(rows: DataFrame) -> DataFrame:
    """The rows with every twentieth part of them dropped, emptied, stripped of its
    sentence ends, repeated, or given to the user, by crc32 of ``conv_id:turn``.

    A dropped row has ``copies`` 0 and a repeated one 2. A null role or text is one
    space, and so is a null conv_id or turn inside the crc32.
    """
    name = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    fault = F.pmod(F.crc32(F.encode(name, "utf-8")), F.lit(20))
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    return rows.select(
        "conv_id",
        F.col("turn").cast("bigint").alias("turn"),
        F.when(fault == 4, "user").otherwise(role).alias("role"),
        F.when(fault == 1, "").when(fault == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.when(fault == 0, 0).when(fault == 3, 2).otherwise(1).alias("copies"),
    )


def digest(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def lines_of(rows: DataFrame) -> DataFrame:
    """Rows without their texts, equal ones of a turn as one with their number ``n``."""
    bare = F.rtrim("text", F.lit(SPACE))
    last = F.substring(bare, -1, 1)
    fault = F.when(F.length(bare) == 0, BLANK).when(last.isin(".", "!", "?"), SOUND).otherwise(TRUNCATED)
    return (
        rows.select("conv_id", "turn", "role", digest(F.col("text")).alias("digest"), fault.alias("fault"), "copies")
        .groupBy("conv_id", "turn", "role", "digest")
        .agg(F.sum("copies").alias("n"), F.min("fault").alias("fault"))
    )


def symbols(lines: DataFrame) -> DataFrame:
    """conv_id, turn, role, digest, n, symbol of a line's first row, symbol of its
    other rows, which are duplicates."""
    real = lines.where((F.col("n") > 0) & (F.col("fault") != BLANK))
    again = (
        real.groupBy("conv_id", "role", "digest")
        .agg(F.count(F.lit(1)).alias("turns"), F.min(F.struct("turn")).alias("first"))
        .where("turns > 1")
        .select(F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("digest").alias("d"), F.col("first.turn").alias("first_turn"), F.lit(True).alias("many"))
    )
    again = common.stored(again, "said-again")  # so that a hot conversation's join can be split
    same = lines["conv_id"].eqNullSafe(again["c"]) & (lines["role"] == again["r"]) & (lines["digest"] == again["d"])
    met = lines.join(again, same, "left")
    later = F.coalesce(F.col("many"), F.lit(False)) & ~F.col("turn").eqNullSafe(F.col("first_turn"))
    fault = F.when(F.col("fault") == BLANK, BLANK).when(later, DUPLICATE).otherwise(F.col("fault"))
    initial = F.substring("role", 1, 1)
    role = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    rest = F.when(F.col("fault") == BLANK, BLANK).otherwise(DUPLICATE)
    code = lambda f: (FIRST + role * 4 + f).cast("int")
    return met.select("conv_id", "turn", "role", "digest", "n", code(fault).alias("symbol"), code(rest).alias("rest"))


def changes(column: pa.Array) -> np.ndarray:
    """Where a value differs from the one before it; nulls are equal."""
    out = np.ones(len(column), dtype=bool)
    if len(column) > 1:
        a, b = column.slice(1), column.slice(0, len(column) - 1)
        differ = pc.fill_null(pc.not_equal(a, b), False).to_numpy(zero_copy_only=False)
        out[1:] = differ | (pc.is_null(a).to_numpy(zero_copy_only=False) != pc.is_null(b).to_numpy(zero_copy_only=False))
    return out


def chunk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The part of each conversation's signature that a batch of sorted lines holds."""
    part, sequence = TaskContext.get().partitionId(), 0
    for batch in batches:
        if not batch.num_rows:
            continue
        conv, turn = batch.column(0), batch.column(1)
        n, symbol, rest = (batch.column(i).to_numpy(zero_copy_only=False) for i in (2, 3, 4))
        there = n > 0
        starts = np.flatnonzero(changes(conv))
        ends = np.append(starts[1:], len(n))
        at = np.concatenate([[0], np.cumsum(n)])
        word = np.repeat(rest, n).astype(np.uint8)
        word[at[:-1][there]] = symbol[there]
        whole = word.tobytes().decode("ascii")
        timed = there & pc.is_valid(turn).to_numpy(zero_copy_only=False)
        turns = pc.fill_null(turn, 0).to_numpy(zero_copy_only=False)
        sig, low, high, distinct = [], [], [], []
        for start, end in zip(starts, ends, strict=True):
            sig.append(whole[at[start] : at[end]])
            seen = turns[start:end][timed[start:end]]
            low.append(int(seen[0]) if len(seen) else None)
            high.append(int(seen[-1]) if len(seen) else None)
            distinct.append(int((np.diff(seen) != 0).sum()) + 1 if len(seen) else 0)
        yield pa.record_batch(
            [
                conv.take(pa.array(starts)),
                pa.array(np.full(len(starts), part, np.int32)),
                pa.array(np.full(len(starts), sequence, np.int32)),
                pa.array(sig, pa.string()),
                pa.array(low, pa.int64()),
                pa.array(high, pa.int64()),
                pa.array(distinct, pa.int64()),
            ],
            names=["conv_id", "part", "seq", "sig", "low", "high", "turns"],
        )
        sequence += 1


def signatures(marked: DataFrame) -> DataFrame:
    """conv_id, sig, gaps of every conversation, also of one whose rows are all gone."""
    kind = marked.schema["conv_id"].dataType.simpleString()
    order = ["conv_id", "turn", "role", "digest"]
    chunks = (
        marked.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select("conv_id", "turn", "n", "symbol", "rest")
        .mapInArrow(chunk, f"conv_id {kind}, part int, seq int, sig string, low bigint, high bigint, turns bigint")
    )
    parts = F.sort_array(F.collect_list(F.struct("part", "seq", "sig", "low", "high", "turns")))
    whole = chunks.groupBy("conv_id").agg(parts.alias("parts"), F.min("low").alias("low"), F.max("high").alias("high"), F.sum("turns").alias("turns"))
    # a turn that ends one part and begins the next was counted in both
    timed = F.filter("parts", lambda p: p["turns"] > 0)
    size = F.size(timed)
    twice = F.aggregate(
        F.sequence(F.lit(0), F.greatest(size - 2, F.lit(0))),
        F.lit(0).cast("bigint"),
        lambda total, i: total + F.when((size > 1) & (F.get(timed, i)["high"] == F.get(timed, i + 1)["low"]), 1).otherwise(0),
    )
    gaps = F.coalesce(F.col("high") - F.col("low") + 1 - (F.col("turns") - twice), F.lit(0))
    return whole.select("conv_id", F.array_join(F.transform("parts", lambda p: p["sig"]), "").alias("sig"), gaps.cast("bigint").alias("gaps"))


COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


def audits(words: DataFrame) -> DataFrame:
    """conv_id, the counts, audit of every signature."""
    kind = words.schema["conv_id"].dataType.simpleString()

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        suffixes, word, known = Suffixes(), None, None
        for batch in batches:
            out = []
            for text in batch.column(1).to_pylist():
                signature = text.encode("ascii")
                if signature != word:
                    code = np.frombuffer(signature, np.uint8) - FIRST
                    faults, roles = np.bincount(code % 4, minlength=4), code // 4
                    pair = roles[:-1] * 4 + roles[1:]
                    illegal = len(pair) - int(np.isin(pair, [0 * 4 + 1, 1 * 4 + 2, 2 * 4 + 1]).sum())
                    audit = suffixes.audit(signature)
                    word = signature
                    known = [int(faults[f]) for f in (BLANK, DUPLICATE, TRUNCATED)] + [illegal, price(audit, signature), audit]
                out.append(known)
            columns = [batch.column(0), batch.column(2)]
            columns += [pa.array([k[i] for k in out], pa.int64()) for i in range(5)] + [pa.array([k[5] for k in out], pa.string())]
            yield pa.record_batch(columns, names=["conv_id", *COUNTS, "audit"])

    ranged = words.withColumn("back", F.reverse("sig")).repartitionByRange("back", "conv_id").sortWithinPartitions("back", "conv_id")
    longs = ", ".join(f"{c} bigint" for c in COUNTS)
    return ranged.select("conv_id", "sig", "gaps").mapInArrow(search, f"conv_id {kind}, {longs}, audit string")


class Repair:
    """The repaired rows of one conversation, in order."""

    def __init__(self, audit: str):
        self.audit, self.at, self.line = audit, 0, 0
        self.system = (len(audit) - audit.count("D")) % 2

    def _wanted(self) -> str:
        return "assistant" if (self.line - self.system) % 2 else "user"

    def inserted(self) -> Iterator[tuple[str, str]]:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            yield self._wanted(), ""
            self.at, self.line = self.at + 1, self.line + 1

    def row(self, role: str, text: str) -> Iterator[tuple[str, str]]:
        """The repaired rows up to and with this one, which may be deleted."""
        yield from self.inserted()
        edit = self.audit[self.at]
        self.at += 1
        if edit != "D":
            yield role if edit == "K" else self._wanted(), text
            self.line += 1


def _repaired_rows(kind: str, counts: bool):
    """The function that walks (audit, then rows) of sorted conversations."""

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        head, repair = None, None
        for batch in batches:
            columns = [batch.column(i) for i in range(6 + len(COUNTS))]
            conv, first, role, text, copies = (columns[i].to_pylist() for i in (0, 1, 3, 4, 5))
            for i in range(batch.num_rows):
                if first[i] == 0:
                    if repair is not None:
                        yield head, repair.inserted(), True
                    head, repair = (conv[i], [c[i].as_py() for c in columns[6:]], text[i]), Repair(text[i])
                else:
                    for _ in range(copies[i]):
                        yield head, repair.row(role[i], text[i]), False
        if repair is not None:
            yield head, repair.inserted(), True

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, empty, out = hashlib.sha256(), True, []

        def flush():
            columns = [pa.array([h[0] for h, _ in out], types[0])] + [pa.array([h[1][i] for h, _ in out], pa.int64()) for i in range(len(COUNTS))]
            columns += [pa.array([h[2] for h, _ in out], pa.string()), pa.array([d for _, d in out], pa.string())]
            return pa.record_batch(columns, names=["conv_id", *COUNTS, "audit", "repaired_sha256"])

        types = [_arrow(kind)]
        for head, lines, last in walk(batches):
            for role, text in lines:
                state.update(("" if empty else "\n").encode() + f"{role}:{text}".encode())
                empty = False
            if last:
                out.append((head, state.hexdigest()))
                state, empty = hashlib.sha256(), True
                if len(out) >= 1000:
                    yield flush()
                    out = []
        if out:
            yield flush()

    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        line, out = 0, []
        for head, lines, last in walk(batches):
            for role, text in lines:
                out.append((head[0], line, role, text))
                line += 1
            if last:
                line = 0
            if len(out) >= 1000:
                yield _lines(out, _arrow(kind))
                out = []
        if out:
            yield _lines(out, _arrow(kind))

    return hashed if counts else written


def _lines(rows: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
    columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (kind, pa.int64(), pa.string(), pa.string()), strict=True)]
    return pa.record_batch(columns, names=["conv_id", "line", "role", "text"])


def _arrow(kind: str) -> pa.DataType:
    return {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[kind]


def _with_audits(rows: DataFrame, found: DataFrame) -> DataFrame:
    """Each conversation's audit and then its rows in order, conversation by conversation."""
    nothing = [F.lit(None).cast("bigint").alias(c) for c in COUNTS]
    heads = found.select("conv_id", F.lit(0).alias("kind"), F.lit(None).cast("bigint").alias("turn"), F.lit("").alias("role"), F.col("audit").alias("text"), F.lit(1).alias("copies"), *COUNTS, F.lit(None).cast("binary").alias("digest"))
    texts = rows.where("copies > 0").select("conv_id", F.lit(1).alias("kind"), "turn", "role", "text", "copies", *nothing, digest(F.col("text")).alias("digest"))
    both = heads.unionByName(texts)
    return both.repartition("conv_id").sortWithinPartitions("conv_id", "kind", "turn", "role", "digest").drop("digest")


def _prepared(conversations: DataFrame) -> DataFrame:
    kind = conversations.schema["conv_id"].dataType.simpleString()
    names = conversations.select("conv_id", "turn", "role", "text")
    return names if kind in ("bigint", "int", "string") else names.withColumn("conv_id", F.col("conv_id").cast("bigint"))


def audited(rows: DataFrame) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit of every
    conversation of ``rows`` (conv_id, turn, role, text, copies)."""
    return audits(signatures(symbols(common.stored(lines_of(rows), "lines"))))


def repair_report(rows: DataFrame) -> DataFrame:
    """The audit of every conversation with the digest of its repaired rows.

    ``rows`` as ``damaged`` gives them. A row's fault is blank (no character but white
    space), duplicate (role and text stand earlier in the conversation) or truncated
    (it does not end in ``. ! ?``), the first that holds. Rows go by turn, a null
    turn first, rows of one turn by role and then by the SHA-256 of their text, so
    ties have one order and repeated rows are neighbours. Conversations with a null
    conv_id are one. Role initials are case-sensitive; a role of any other initial,
    an empty one too, can only be deleted or given to user or assistant. An empty
    table gives none. Other columns are not read.
    """
    kind = rows.schema["conv_id"].dataType.simpleString()
    found = audited(rows)
    longs = ", ".join(f"{c} bigint" for c in COUNTS)
    return _with_audits(rows, found).mapInArrow(_repaired_rows(kind, True), f"conv_id {kind}, {longs}, audit string, repaired_sha256 string")


def repaired(conversations: DataFrame) -> DataFrame:
    """conv_id, line (from 0), role, text of the conversations after the cheapest
    repair, without any damage done first. Nulls, ties and so on as in ``repair_report``."""
    common.ship(conversations.sparkSession)
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text"))
    rows = _prepared(conversations).select("conv_id", F.col("turn").cast("bigint").alias("turn"), role, text, F.lit(1).alias("copies"))
    kind = rows.schema["conv_id"].dataType.simpleString()
    return _with_audits(rows, audited(rows)).mapInArrow(_repaired_rows(kind, False), f"conv_id {kind}, line bigint, role string, text string")


def query(spark: SparkSession, folder: str) -> DataFrame:
    return repair_report(damaged(_prepared(common.table(spark, folder, "conversations"))))


def _sql() -> str:
    """The same in SQL: a recursion from each conversation's last row to its first."""
    best = lambda *options: f"list_sort([{', '.join(options)}])[1]"
    option = lambda cost, letter, state: f"{{'c': s{state}.c + {cost}, 'a': '{letter}' || s{state}.a}}"
    never = f"{{'c': {NEVER}, 'a': ''}}"
    states = []
    for state, target in enumerate(ENTER):
        keep = "".join(f"when r.role = {i} then {option('r.mend', 'K', k)} " for i, k in enumerate(KEEP[state]) if k is not None)
        kept = f"case when r.must then {never} {keep} else {never} end"
        moved = f"case when r.must then {never} else {option(f'{REROLE} + r.mend', 'R', target)} end"
        states.append(f"{best(option(DELETE, 'D', state), kept, moved)} as b{state}")
    more = lambda b: f"{{'c': {b}.c + {INSERT}, 'a': 'I' || {b}.a}}"
    return f"""
with recursive bits as (
    select distinct conv_id, turn, list_reduce(
        list_prepend(4294967295::bigint, flatten(list_transform(
            string_split(encode(coalesce(cast(conv_id as varchar), ' ') || ':' || coalesce(cast(turn as varchar), ' '))::varchar, ''),
            lambda ch: [ascii(ch)::bigint, 0, 0, 0, 0, 0, 0, 0]))),
        lambda c, b: xor(xor(c, b) >> 1, 3988292384 * (xor(c, b) & 1))) as crc
    from conversations
), hurt as (
    select c.conv_id, c.turn, xor(b.crc, 4294967295) % 20 as h, coalesce(c.role, ' ') as role, coalesce(c.text, ' ') as text
    from conversations c join bits b on c.conv_id is not distinct from b.conv_id and c.turn is not distinct from b.turn
), kept as (
    select conv_id, turn, case when h = 4 then 'user' else role end as role,
           case when h = 1 then '' when h = 2 then translate(text, '.!?', '') else text end as text,
           unnest(case when h = 0 then [] when h = 3 then [1, 2] else [1] end) as copy
    from hurt
), placed as (
    select *, row_number() over (partition by conv_id order by turn nulls first, role, sha256(text)) as i,
           rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) as bare
    from kept
), met as (
    select *, row_number() over (partition by conv_id, role, text order by i) as nth from placed
), faults as (
    select conv_id, turn, role, text, i, strpos('sua', left(role, 1)) - 1 as found, left(role, 1) as initial,
           case when bare = '' then 2 when nth > 1 then 3 when right(bare, 1) in ('.', '!', '?') then 0 else 1 end as fault,
           count(*) over (partition by conv_id) as n,
           lag(left(role, 1)) over (partition by conv_id order by i) || left(role, 1) as pair
    from met
), ready as (
    select conv_id, i, n, case when initial = '' then 3 when found < 0 then 3 else found end as role,
           fault >= 2 as must, case when fault = 1 then {MENDED} else 0 end as mend
    from faults
), walk as (
    select distinct conv_id, n as i, {{'c': 0, 'a': ''}} as s0, {{'c': 6, 'a': 'II'}} as s1, {{'c': 3, 'a': 'I'}} as s2, {{'c': 0, 'a': ''}} as s3
    from ready
    union all
    select conv_id, i, {best("b0", more(best("b2", more("b3"))))}, {best("b1", more(best("b2", more("b3"))))},
           {best("b2", more("b3"))}, {best("b3", more("b2"))}
    from (
        select w.conv_id, w.i - 1 as i, {", ".join(states)}
        from walk w join ready r on r.conv_id is not distinct from w.conv_id and r.i = w.i
    )
), audit as (
    select conv_id, s0.c as cost, s0.a as audit from walk where i = 0
), letters as (
    select conv_id, unnest(string_split(audit, '')) as letter, generate_subscripts(string_split(audit, ''), 1) as pos,
           length(replace(audit, 'D', '')) % 2 as shift
    from audit
), numbered as (
    select *, sum(case when letter <> 'I' then 1 else 0 end) over (partition by conv_id order by pos) as i,
           sum(case when letter <> 'D' then 1 else 0 end) over (partition by conv_id order by pos) as line
    from letters
), mended as (
    select l.conv_id, l.pos,
           case when l.letter = 'K' then f.role when (l.line - 1 - l.shift) % 2 = 0 then 'user' else 'assistant' end
           || ':' || case when l.letter = 'I' then '' else f.text end as line
    from numbered l left join faults f on f.conv_id is not distinct from l.conv_id and f.i = l.i and l.letter <> 'I'
    where l.letter <> 'D'
), hashes as (
    select conv_id, sha256(string_agg(line, chr(10) order by pos)) as h from mended group by conv_id
), counts as (
    select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps,
           count(*) filter (where fault = 2) as blank, count(*) filter (where fault = 3) as duplicate, count(*) filter (where fault = 1) as truncated,
           count(*) filter (where i > 1 and pair not in ('su', 'ua', 'au')) as illegal
    from faults group by conv_id
)
select o.conv_id, coalesce(c.gaps, 0)::bigint as gaps, coalesce(c.blank, 0)::bigint as blank, coalesce(c.duplicate, 0)::bigint as duplicate,
       coalesce(c.truncated, 0)::bigint as truncated, coalesce(c.illegal, 0)::bigint as illegal, coalesce(a.cost, 0)::bigint as cost,
       coalesce(a.audit, '') as audit, coalesce(h.h, sha256('')) as repaired_sha256
from (select distinct conv_id from conversations) o
left join counts c on c.conv_id is not distinct from o.conv_id
left join audit a on a.conv_id is not distinct from o.conv_id
left join hashes h on h.conv_id is not distinct from o.conv_id
"""


SQL = _sql()
