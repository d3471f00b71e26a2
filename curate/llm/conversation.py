"""Conversation structure repair by Hirschberg's divide and conquer.

A conversation is legal when its roles read ``(s?(ua)+)?``: an automaton of four
states.  The cheapest edits from one state to another over a run of rows come from
vectors of four costs: one runs forward to the middle of the run, one backward from its
end, and they meet at the state where their sum is least.  Of several such states the one
with the ASCII-least audit on its left is taken (behind an equal left side the rest is
the same; a left side that another one only lengthens by inserts comes first), and both
halves are solved in the same way.  No table of all rows and states is kept.

A conversation may be of any length.  Rows are ordered once by a range sort over all
conversations, so that a long one spreads over many tasks, and cut into blocks of at most
``BLOCK`` rows.  A block is summed up by its 4 x 4 matrix of costs; the matrices of a
conversation give each block the cost of all that follows; each block is then solved
for every state it may be entered in, and the entries are chained.  Only digests take a
whole conversation's rows in turn, one at a time.  Rows that are equal in all columns
are counted and kept as one, all but the first of them being duplicates.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from curate.llm.textbytes import materialise

#: Rows of a block are those whose places agree but for so many low bits.
BLOCK_BITS = 12
SPACES = " \t\n\x0b\x0c\r"
INF = 1 << 60
#: Costs of the edits, and the states a conversation may end in (start and behind an answer).
RETYPE, DROP, ADD, CUT = 3, 4, 3, 3
ENDS = (0, INF, INF, 0)
#: The state behind an inserted row, the role it has, and the kind of row that a state takes next.
NEXT = (2, 2, 3, 2)
ROLE = ("user", "user", "assistant", "user")

# ---------------------------------------------------------------------------
# One run of rows.  A row is ("s", "u", "a" or "", truncated) or a number of
# rows that must go.


def closed(v: list[int]) -> list[int]:
    """Costs after any inserts."""
    u = min(v[2], v[0] + ADD, v[1] + ADD, v[3] + ADD)
    a = min(v[3], u + ADD)
    return [v[0], v[1], min(u, a + ADD), a]


def forward(rows: list, lo: int, hi: int, v: list[int]) -> list[int]:
    """Least costs of each state behind rows lo:hi, from costs v before them."""
    v = closed(v)
    for row in rows[lo:hi]:
        if isinstance(row, int):
            v = [x + DROP * row for x in v]
            continue
        kind, cut = row
        extra = CUT if cut else 0
        v = closed([
            v[0] + DROP,
            min(v[1] + DROP, v[0] + extra) if kind == "s" else v[1] + DROP,
            min(v[2] + DROP, min(v[0], v[1], v[3]) + extra + (0 if kind == "u" else RETYPE)),
            min(v[3] + DROP, v[2] + extra + (0 if kind == "a" else RETYPE))])
    return v


def backward(rows: list, lo: int, hi: int, after: list[int]) -> list[int]:
    """Least costs from each state before rows lo:hi to the end, given the costs behind them."""

    def opened(v: list[int]) -> list[int]:
        u = min(v[2], v[3] + ADD)
        a = min(v[3], u + ADD)
        u = min(u, a + ADD)
        return [min(v[0], u + ADD), min(v[1], u + ADD), u, a]

    v = opened(list(after))
    for row in reversed(rows[lo:hi]):
        if isinstance(row, int):
            v = [x + DROP * row for x in v]
            continue
        kind, cut = row
        extra = CUT if cut else 0
        user = v[2] + extra + (0 if kind == "u" else RETYPE)
        v = opened([
            min(v[0] + DROP, user, v[1] + extra if kind == "s" else INF),
            min(v[1] + DROP, user),
            min(v[2] + DROP, v[3] + extra + (0 if kind == "a" else RETYPE)),
            min(v[3] + DROP, user)])
    return v


def _edits(row, state: int) -> Iterator[tuple[int, str, int]]:
    """(cost, initial, next state) of what may be done to a row in a state."""
    if isinstance(row, int):
        yield DROP * row, "D", state
        return
    kind, cut = row
    extra = CUT if cut else 0
    yield DROP, "D", state
    if kind == "s" and state == 0:
        yield extra, "K", 1
    yield (extra, "K", NEXT[state]) if kind == ROLE[state][0] else (extra + RETYPE, "R", NEXT[state])


def _one(rows: list, lo: int, hi: int, start: int, after: tuple[int, ...]) -> tuple[str, int]:
    best = None
    before, spent, p = "", 0, start
    for _ in range(4):
        for cost, initial, q in _edits(rows[lo], p) if hi > lo else ((0, "", p),):
            audit, total = before + initial, spent + cost
            for _ in range(4):
                if after[q] < INF and (best is None or (total + after[q], audit) < best[:2]):
                    best = total + after[q], audit, q
                audit, total, q = audit + "I", total + ADD, NEXT[q]
        before, spent, p = before + "I", spent + ADD, NEXT[p]
    return best[1:]


def solve(rows: list, start: int, after: tuple[int, ...] = ENDS) -> tuple[str, int]:
    """The ASCII-least of the cheapest audits of ``rows`` from state ``start``, and the state behind it.

    ``after`` is the cost still to come from each state behind the rows.  Rows that must
    go together count as one initial, ``D``.
    """
    halves: dict[tuple, tuple[str, int]] = {}

    def between(lo: int, hi: int, p: int, after: tuple[int, ...]) -> tuple[str, int]:
        key = (lo, hi, p, after)
        if key not in halves:
            halves[key] = meet(*key)
        return halves[key]

    def meet(lo: int, hi: int, p: int, after: tuple[int, ...]) -> tuple[str, int]:
        if hi - lo < 2:
            return _one(rows, lo, hi, p, after)
        mid = (lo + hi) // 2
        there = [INF] * 4
        there[p] = 0
        costs = [a + b for a, b in zip(forward(rows, lo, mid, there), backward(rows, mid, hi, list(after)))]
        least = min(costs)
        left, s = min(between(lo, mid, p, tuple(0 if k == s else INF for k in range(4))) for s in range(4) if costs[s] == least)
        right, q = between(mid, hi, s, after)
        return left + right, q

    return between(0, len(rows), start, tuple(after))


def matrix(rows: list) -> list[int]:
    """Least costs from each state before ``rows`` to each behind them, row by row."""
    return [x for p in range(4) for x in forward(rows, 0, len(rows), [0 if k == p else INF for k in range(4)])]


# ---------------------------------------------------------------------------
# Streams of sorted rows.


def _pieces(batches: Iterator[pa.RecordBatch], size: int = 256) -> Iterator[dict]:
    for batch in batches:
        for i in range(0, batch.num_rows, size):
            yield from batch.slice(i, size).to_pylist()


def _runs(batches: Iterator[pa.RecordBatch], *keys: str) -> Iterator[list[dict]]:
    """Neighbouring rows of equal keys, across batches."""
    held: list[dict] = []
    for row in _pieces(batches):
        if held and any(row[k] != held[0][k] for k in keys):
            yield held
            held = []
        held.append(row)
    if held:
        yield held


def _emit(rows: Iterator[dict], schema: pa.Schema, size: int = 1024, limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    held, weight = [], 0
    for row in rows:
        held.append(row)
        weight += len(row.get("text") or "") + len(row.get("audit") or "")
        if len(held) >= size or weight > limit:
            yield pa.RecordBatch.from_pylist(held, schema)
            held, weight = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


def _streamed(df: DataFrame, fn, conv: StructField, **columns: str) -> DataFrame:
    """``fn`` (rows of a partition in, dictionaries out) with the conversation's id and further columns."""
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = StructType([conv, *StructType.fromDDL(", ".join(f"{c} {t}" for c, t in columns.items())).fields])
    arrow = to_arrow_schema(schema)
    return df.mapInArrow(lambda batches: _emit(fn(batches), arrow), schema)


def _units(row: dict) -> list:
    """The rows that a counted row stands for, as ``solve`` takes them."""
    if not row["n"]:
        return []
    if row["blank"] or not row["first"]:
        return [row["n"]]
    kind = row["initial"] if row["initial"] in ("s", "u", "a") else ""
    return [(kind, row["cut"]), *([row["n"] - 1] if row["n"] > 1 else [])]


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """A block's costs, counts, and what its neighbours need to know of its ends."""
    for run in _runs(batches, "conv_id", "block"):
        live = [r for r in run if r["n"]]
        turns = [r["turn"] for r in live if r["turn"] is not None]
        initials = [r["initial"] for r in live]
        yield {
            "conv_id": run[0]["conv_id"], "block": run[0]["block"], "at": run[0]["at"], "m": matrix([u for r in live for u in _units(r)]), "rows": sum(r["n"] for r in live),
            "blank": sum(r["n"] for r in live if r["blank"]), "duplicate": sum(r["n"] - bool(r["first"]) for r in live if not r["blank"]),
            "truncated": sum(1 for r in live if r["first"] and not r["blank"] and r["cut"]),
            "illegal": sum(r["n"] - 1 for r in live) + sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
            "initials": [initials[0], initials[-1]] if live else [], "turns": [turns[0], turns[-1], len(set(turns))] if turns else []}


def _chain(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """For each block what comes behind it costs; with a conversation's first block, its counts."""
    for run in _runs(batches, "conv_id"):
        after, costs = list(ENDS), []
        for block in reversed(run):
            costs.append(after)
            m = block["m"]
            after = [min(m[4 * p + q] + after[q] for q in range(4)) for p in range(4)]
        counts = {c: sum(b[c] for b in run) for c in ("blank", "duplicate", "truncated", "illegal")}
        ends = [b["initials"] for b in run if b["initials"]]
        counts["illegal"] += sum(a[1] + b[0] not in ("su", "ua", "au") for a, b in zip(ends, ends[1:]))
        turns = [b["turns"] for b in run if b["turns"]]
        distinct = sum(t[2] for t in turns) - sum(a[1] == b[0] for a, b in zip(turns, turns[1:]))
        counts |= {"gaps": turns[-1][1] - turns[0][0] + 1 - distinct if turns else 0, "cost": after[0]}
        for k, (block, costs_after) in enumerate(zip(run, reversed(costs))):
            yield {"conv_id": block["conv_id"], "block": block["block"], "at": block["at"], "lead": k == 0, "after": [min(x, INF) for x in costs_after], **(counts if k == 0 else dict.fromkeys(counts))}


def _audits(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Each block's audit for every state it may be entered in (the first one: the start only)."""
    for run in _runs(batches, "conv_id", "block"):
        head, rows = run[0], [u for r in run[1:] for u in _units(r)]
        found = [solve(rows, p, tuple(head["after"])) for p in range(1 if head["lead"] else 4)]
        yield {"conv_id": head["conv_id"], "block": head["block"], "at": head["at"], "audits": [a for a, _ in found], "exits": [q for _, q in found],
               "later": [r["at"] for r in run[1:] if not r["first"]]}


def _choose(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Each block's audit for the state in which the one before it ends."""
    last, state = None, 0
    for row in _pieces(batches):
        state = state if last is not None and last["conv_id"] == row["conv_id"] else 0
        yield {"conv_id": row["conv_id"], "block": row["block"], "at": row["at"], "audit": row["audits"][state], "state": state, "later": row["later"]}
        state, last = row["exits"][state], row


def _apply(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """The edits of each block's rows, inserted ones included, in order; equal rows that go count as one edit.

    Inserts that follow a block's last row stand with that row; only the rows ``solve`` saw use up initials."""
    audit, k, seq, state, at = "", 0, 0, 0, 0
    rows = _pieces(batches)
    head: dict | None = next(rows, None)
    while head is not None:
        audit, state, k, seq, at = head["audit"], head["state"], 0, 0, head["at"]
        out, later = {"conv_id": head["conv_id"], "times": 1}, set(head["later"])

        def inserted():
            nonlocal k, seq, state
            while k < len(audit) and audit[k] == "I":
                yield {**out, "at": at, "seq": seq, "edit": "I", "role": ROLE[state], "text": ""}
                k, seq, state = k + 1, seq + 1, NEXT[state]

        for row in rows:
            if row["audit"] is not None:
                break
            at, seq = row["at"], 0
            for unit in _units(row | {"first": at not in later, "cut": False}):
                yield from inserted()
                edit = audit[k]
                made = {**out, "at": at, "seq": seq, "edit": edit, "role": None, "text": None}
                if edit == "D":
                    made["times"] = unit if isinstance(unit, int) else 1
                elif edit == "K" and unit[0] == "s":
                    made |= {"role": row["role"], "text": row["text"]}
                    state = 1
                else:
                    made |= {"role": row["role"] if edit == "K" else ROLE[state], "text": row["text"]}
                    state = NEXT[state]
                yield made
                k, seq = k + 1, seq + 1
        else:
            row = None
        yield from inserted()
        head = row


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Audit and digest of each conversation; of its texts one is held at a time."""
    now, audit, digest, any_row = None, [], None, False
    for row in _pieces(batches):
        if now is None or now[0] != row["conv_id"]:
            if now is not None:
                yield {"conv_id": now[0], "audit": "".join(audit), "repaired_sha256": digest.hexdigest()}
            now, audit, digest, any_row = (row["conv_id"],), [], hashlib.sha256(), False
        audit.append(row["edit"] * row["times"])
        if row["edit"] != "D":
            digest.update((("\n" if any_row else "") + f"{row['role']}:{row['text']}").encode())
            any_row = True
    if now is not None:
        yield {"conv_id": now[0], "audit": "".join(audit), "repaired_sha256": digest.hexdigest()}


# ---------------------------------------------------------------------------
# Over all conversations.


def _fault_columns(text: Column) -> tuple[Column, Column]:
    core = F.rtrim(text, F.lit(SPACES))
    return core == "", ~F.substring(core, -1, 1).isin(".", "!", "?")


def ordered(turns: DataFrame) -> DataFrame:
    """Rows of (conv_id, turn, role, text, n) in one order over all conversations, written once.

    ``at`` is the place of a row in that order, ``block`` the run of places it belongs to;
    equal rows are one, with their number ``n`` (0: none is left).  Rows of a turn are
    ordered by role and text.
    """
    rows = turns.groupBy("conv_id", "turn", "role", "text").agg(F.sum("n").alias("n"))
    keys = [F.col(c).asc_nulls_first() for c in ("conv_id", "turn", "role", "text")]
    rows = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("at", F.monotonically_increasing_id())
    return materialise(rows.withColumn("block", F.shiftright("at", BLOCK_BITS)), "turns")


def judged(rows: DataFrame) -> DataFrame:
    """The rows without their texts: role initial, blank, cut off, first of its role and text in the conversation."""
    blank, cut = _fault_columns(F.col("text"))
    firsts = (rows.filter((F.col("n") > 0) & ~blank).groupBy("conv_id", "role", F.sha2(F.col("text").cast("binary"), 256).alias("sha"))
              .agg(F.min("at").alias("at")).select("at", F.lit(True).alias("first")))
    narrow = rows.select("conv_id", "turn", "n", "at", "block", F.substring("role", 1, 1).alias("initial"), blank.alias("blank"), cut.alias("cut"))
    return materialise(narrow.join(firsts, "at", "left").withColumn("first", F.coalesce("first", F.lit(False))), "judged")


def _headed(heads: DataFrame, rows: DataFrame) -> DataFrame:
    """The rows of each block behind the row that says what to do with them."""
    both = heads.withColumn("_body", F.lit(False)).unionByName(rows.withColumn("_body", F.lit(True)), allowMissingColumns=True)
    return both.repartition("conv_id", "block").sortWithinPartitions("at", "_body")


def repair(turns: DataFrame, times_col: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(edits, counts) of conversations given by conv_id, turn, role and text; other columns are not read.

    ``edits``: conv_id, at, seq (their order), edit (K keep, R change the role, D delete,
    I insert), times, role, text (both null if deleted); those not deleted are the
    repaired conversation.  ``counts``: one row for each conv_id with gaps, blank,
    duplicate, truncated, illegal and cost.  A null role or text counts as one space (and so
    is blank), null turns come first, and rows with a null conv_id are one conversation.  Rows
    of one turn are ordered by role and text; equal rows are duplicates.  ``times_col`` says how often
    a row stands (null or 0: not at all; its conversation is still counted).  Without rows there are none.
    """
    conv = StructField("conv_id", turns.schema["conv_id"].dataType)
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c)  # noqa: E731
    times = F.coalesce(F.col(times_col), F.lit(0)).cast("bigint") if times_col else F.lit(1).cast("bigint")
    rows = ordered(turns.select("conv_id", F.col("turn").cast("bigint"), space("role"), space("text"), times.alias("n")))
    narrow = judged(rows)
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    sums = _streamed(narrow.repartition("conv_id", "block").sortWithinPartitions("at"), _sums, conv, block="long", at="long", m="array<long>", rows="long", blank="long", duplicate="long",
                     truncated="long", illegal="long", initials="array<string>", turns="array<long>")
    chained = _streamed(sums.repartition("conv_id").sortWithinPartitions("conv_id", "block"), _chain, conv, block="long", at="long", lead="boolean", after="array<long>", **dict.fromkeys(counts, "long"))
    chained = materialise(chained, "blocks")
    audits = _streamed(_headed(chained.select("conv_id", "block", "at", "lead", "after"), narrow), _audits, conv, block="long", at="long", audits="array<string>", exits="array<int>", later="array<long>")
    chosen = _streamed(audits.repartition("conv_id").sortWithinPartitions("conv_id", "block"), _choose, conv, block="long", at="long", audit="string", state="int", later="array<long>")
    texts = rows.select("conv_id", "n", "at", "block", "role", "text", F.substring("role", 1, 1).alias("initial"), _fault_columns(F.col("text"))[0].alias("blank"))
    edits = _streamed(_headed(chosen, texts), _apply, conv, at="long", seq="long", edit="string", times="long", role="string", text="string")
    return edits, chained.filter("lead").select("conv_id", *counts)


def damage(conversations: DataFrame) -> DataFrame:
    """Conversations with faults of known kinds, fixed by crc32 of ``conv_id:turn``: of 20 rows one each goes
    (n = 0), loses its text, loses its ``.!?``, stands twice (n = 2), or becomes the user's.  Nulls are one space."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))  # noqa: E731
    fault = F.pmod(F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn")).cast("binary")), F.lit(20))
    text, role = space("text"), space("role")
    return conversations.select(
        "conv_id", "turn",
        F.when(fault == 4, "user").when(fault == 0, "").otherwise(role).alias("role"),
        F.when(fault.isin(0, 1), "").when(fault == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.when(fault == 0, 0).when(fault == 3, 2).otherwise(1).cast("bigint").alias("n"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    edits, counts = repair(damage(spark.read.parquet(f"{sf_dir}/conversations.parquet")), "n")
    conv = counts.schema["conv_id"]
    digests = _streamed(edits.repartition("conv_id").sortWithinPartitions("conv_id", "at", "seq"), _digests, conv, audit="string", repaired_sha256="string")
    digests = digests.withColumnRenamed("conv_id", "_conv")
    return counts.join(digests, F.col("conv_id").eqNullSafe(F.col("_conv")), "left").select(
        "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"))


def _sql() -> str:
    """The contract as a recursive query: for each state the least (cost, audit) of a conversation's first rows."""
    add = lambda x, role: f"{{'c': {x}.c + 3, 'a': {x}.a || 'I', 'r': list_append({x}.r, '{role}:')}}"  # noqa: E731
    step = lambda x, cost, initial, line: f"{{'c': {x}.c + {cost}, 'a': {x}.a || '{initial}', 'r': {f'list_append({x}.r, {line})' if line else f'{x}.r'}}}"  # noqa: E731
    least = lambda *x: f"list_min([{', '.join(x)}])"  # noqa: E731
    must, extra = "CASE WHEN bad THEN 1000000 ELSE 0 END", "CASE WHEN cut THEN 3 ELSE 0 END"

    def take(x: str, role: str) -> str:
        keep, free = f"role || ':' || text", f"{extra} + {must}"
        return (f"CASE WHEN substr(role, 1, 1) = '{role[0]}' THEN {step(x, free, 'K', keep)} "
                f"ELSE {step(x, f'3 + {free}', 'R', f"'{role}:' || text")} END")

    first = f"CASE WHEN substr(role, 1, 1) = 's' THEN {step('v0', f'{extra} + {must}', 'K', "role || ':' || text")} ELSE {step('v0', '1000000', 'D', '')} END"
    closing = lambda source: f"""SELECT conv_id, i, v0, v1, {least('u', add('a', 'user'))} AS v2, a AS v3 FROM (
      SELECT *, {least('v3', add('u', 'assistant'))} AS a FROM (
        SELECT *, {least('v2', add('v0', 'user'), add('v1', 'user'), add('v3', 'user'))} AS u FROM ({source})))"""  # noqa: E731
    never = "{'c': 1000000, 'a': '', 'r': CAST([] AS VARCHAR[])}"
    start = f"SELECT conv_id, CAST(0 AS BIGINT) AS i, {never.replace('1000000', '0')} AS v0, {never} AS v1, {never} AS v2, {never} AS v3 FROM convs"
    moved = f"""SELECT o.conv_id, o.i, {step('v0', '4', 'D', '')} AS v0, {least(step('v1', '4', 'D', ''), first)} AS v1,
        {least(step('v2', '4', 'D', ''), take('v0', 'user'), take('v1', 'user'), take('v3', 'user'))} AS v2,
        {least(step('v3', '4', 'D', ''), take('v2', 'assistant'))} AS v3
      FROM best b JOIN ord o ON o.conv_id IS NOT DISTINCT FROM b.conv_id AND o.i = b.i + 1"""
    return rf"""
WITH RECURSIVE convs AS (SELECT DISTINCT conv_id FROM conversations),
poly AS (SELECT list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         list_concat([CAST(4294967295 AS BIGINT)], list_transform(string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''), lambda x: CAST(ascii(x) AS BIGINT))) AS bytes
  FROM conversations),
fault AS (SELECT conv_id, turn, role, text, xor(list_reduce(bytes, lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295) % 20 AS f FROM keyed, poly),
hurt AS (
  SELECT conv_id, turn, CASE WHEN f = 4 THEN 'user' ELSE role END AS role,
         CASE f WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text, unnest(range(CASE f WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy
  FROM fault),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM hurt),
marked AS (
  SELECT *, NOT regexp_matches(text, '[^ 	-]') AS blank, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again,
         NOT regexp_matches(text, '[.!?][ 	-]*$') AS short, lag(substr(role, 1, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS before FROM placed),
ord AS (SELECT *, blank OR again AS bad, short AND NOT (blank OR again) AS cut FROM marked),
best AS (
  {closing(start)}
  UNION ALL
  {closing(moved)}),
done AS (SELECT conv_id, {least('v0', 'v3')} AS e FROM best QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY i DESC) = 1),
counted AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count_if(blank) AS blank, count_if(again AND NOT blank) AS duplicate, count_if(cut) AS truncated,
         count_if(before IS NOT NULL AND before || substr(role, 1, 1) NOT IN ('su', 'ua', 'au')) AS illegal FROM ord GROUP BY conv_id)
SELECT d.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank, CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate,
       CAST(coalesce(truncated, 0) AS BIGINT) AS truncated, CAST(coalesce(illegal, 0) AS BIGINT) AS illegal,
       CAST(e.c AS BIGINT) AS cost, e.a AS audit, sha256(array_to_string(e.r, chr(10))) AS repaired_sha256
FROM done d LEFT JOIN counted c ON d.conv_id IS NOT DISTINCT FROM c.conv_id"""


QUERIES = {"op12_conversation_repair": op12_conversation_repair}
ORACLE = {"op12_conversation_repair": _sql()}
