"""Conversation structure repair: a generalised LR parse of the roles, with weighted edits.

The role grammar is

    Conversation -> (nothing) | s Exchanges | Exchanges        Exchanges -> u a | Exchanges u a

over the first letters of system, user and assistant. A stack of LR states is a chain of nodes that share their tails (a
graph-structured stack). Every row is read in all ways at once: kept (cost 0, if the grammar can shift it), given another
role (3), deleted (4), each after any number of inserted rows (3 each); equal stacks merge, and the least (cost, audit)
of them stays. The audit holds the initials of the edits in order: D, I, K, R.

What a row costs depends only on a symbol: its role's first letter, whether it must go (blank, or a repetition of an
earlier row's role and text) and whether it is truncated (its last character other than white space is not one of
``.!?``; 3 if it is not deleted). Spark marks the rows, a conversation becomes a string of symbols, and only that string is
parsed in Python; texts never leave the JVM.

Audits of one length compare as (rank of the audit they go on from, what is added), since none of two different audits
that have read the same rows is the beginning of the other. So the parse takes time and memory in proportion to the
number of rows.

Rows are ordered by turn, nulls first, then by role and text. A null role or text is one blank; so a null text is blank,
and a role that does not begin with s, u or a can't be kept. Repeated rows are duplicates. Rows without a conv_id are one
conversation, whose conv_id is null. A conversation is one value of the result (its repaired rows), so it has to fit
into a task; that is the only group that does. An empty table gives none. Other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pairsmith.functions.binding import let
from pairsmith.llm.tables import table

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
MUST_GO = "x"
REMEMBERED = 100_000

#: States of the LR automaton: where the four grammar symbols lead to, and what is reduced before u or the end.
SHIFT = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 6}, 3: {"u": 7}, 5: {"u": 7}, 7: {"a": 8}}
REDUCE = {6: 2, 8: 3}            # u a, and Exchanges u a: how many states the rule takes off the stack
GOTO = {0: 3, 1: 5}              # Exchanges, at the beginning and after s
ACCEPT = {0, 3, 5}


@dataclass(frozen=True, eq=False)
class Node:
    """The top of a stack, and the node below it."""

    state: int
    below: Node | None


class Stacks:
    """Nodes of all stacks so far; equal stacks are one node."""

    def __init__(self):
        self.known: dict[tuple, Node] = {}
        self.shifted: dict[tuple, Node | None] = {}
        self.bottom = self.node(0, None)

    def node(self, state: int, below: Node | None) -> Node:
        return self.known.setdefault((state, id(below)), Node(state, below))

    def shift(self, top: Node, symbol: str) -> Node | None:
        """The stack after ``symbol``, reduced as far as it goes, or None."""
        if (top, symbol) not in self.shifted:
            state = SHIFT.get(top.state, {}).get(symbol)
            after = None if state is None else self.node(state, top)
            while after and after.state in REDUCE:
                for _ in range(REDUCE[after.state]):
                    after = after.below
                after = self.node(GOTO[after.state], after)
            self.shifted[top, symbol] = after
        return self.shifted[top, symbol]


_stacks = Stacks()  # the grammar is regular, so there are few stacks


def _with_inserts(tops: dict[Node, tuple[int, int, int]]) -> dict[Node, tuple[int, int, int, str]]:
    """All stacks that any number of inserted rows leads to: (cost, rank, place before, inserts)."""
    best = {top: (*entry, "") for top, entry in tops.items()}
    todo = list(best)
    while todo:
        top = todo.pop()
        cost, rank, place, added = best[top]
        for role in "ua":
            after, entry = _stacks.shift(top, role), (cost + INSERT, rank, place, added + "I")
            if after and (after not in best or (entry[0], entry[1], entry[3]) < (best[after][0], best[after][1], best[after][3])):
                best[after] = entry
                todo.append(after)
    return best


def parse(symbols: str) -> tuple[int, str]:
    """Least cost of a conversation's symbols, and the ASCII-least audit of that cost."""
    tops = {_stacks.bottom: (0, 0, 0)}  # cost, rank of the audit so far, its place in the trail
    trail: list[list[tuple[int, str]]] = []
    for symbol in symbols:
        late = TRUNCATED if symbol.isupper() else 0
        new: dict[Node, tuple[int, int, str, int]] = {}
        for top, (cost, rank, place, added) in _with_inserts(tops).items():
            ways = [(top, cost + DELETE, "D")]
            if symbol != MUST_GO:
                ways += [(_stacks.shift(top, symbol.lower()), cost + KEEP + late, "K")]
                ways += [(_stacks.shift(top, role), cost + REROLE + late, "R") for role in "ua"]
            for after, total, edit in ways:
                entry = (total, rank, added + edit, place)
                if after and (after not in new or entry < new[after]):
                    new[after] = entry
        order = {audit: i for i, audit in enumerate(sorted({(e[1], e[2]) for e in new.values()}))}
        tops = {top: (e[0], order[e[1], e[2]], i) for i, (top, e) in enumerate(new.items())}
        trail.append([(e[3], e[2]) for e in new.values()])
    cost, _, added, place = min((c, r, added, p) for top, (c, r, p, added) in _with_inserts(tops).items() if top.state in ACCEPT)
    audit = [added]
    for step in reversed(trail):
        place, edit = step[place]
        audit.append(edit)
    return cost, "".join(reversed(audit))


def edits(symbols: str, audit: str) -> list[tuple[int | None, str | None]]:
    """The repaired rows as (row they come from, new role), None where there is none or it stays. Roles follow from the
    grammar, since only a kept row can be the system's."""
    out, read, turns = [], 0, 0
    for edit in audit:
        if edit != "D":
            kept_system = edit == "K" and symbols[read].lower() == "s"
            out.append((None if edit == "I" else read, None if edit == "K" else ("user", "assistant")[turns % 2]))
            turns += not kept_system
        read += edit != "I"
    return out


_parsed: dict[str, tuple] = {}  # most conversations have one of few shapes


def _parse_once(symbols: str) -> tuple:
    if symbols not in _parsed:
        if len(_parsed) >= REMEMBERED or len(symbols) > 1000:
            _parsed.clear()
        cost, audit = parse(symbols)
        _parsed[symbols] = cost, audit, [{"source": i, "role": role} for i, role in edits(symbols, audit)]
    return _parsed[symbols]


def _parse_column():
    @F.udf("cost long, audit string, edits array<struct<source: int, role: string>>", useArrow=True)
    def run(symbols):
        return _parse_once(symbols or "")

    return run


def _last_visible(text: Column) -> Column:
    return F.substring(F.regexp_replace(text, r"[\x20\x09-\x0D]+\z", ""), -1, 1)


def _marked(rows: DataFrame) -> DataFrame:
    """turn, role, text, blank, ended: what a row tells by itself."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(" "))
    return rows.select(
        "conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"), text.alias("text"),
        (~text.rlike(r"[^\x20\x09-\x0D]")).alias("blank"), F.coalesce(_last_visible(text).isin(".", "!", "?"), F.lit(False)).alias("ended"))


def _symbol(row: Column) -> Column:
    initial = F.substring(row["role"], 1, 1)
    letter = F.when(initial.isin("s", "u", "a"), initial).otherwise("o")
    return F.when(row["blank"] | row["seen"], MUST_GO).when(row["ended"], letter).otherwise(F.upper(letter))


def _count(rows: Column, test) -> Column:
    return F.size(F.filter(rows, test)).cast("long")


def _repaired(rows: Column, edits: Column) -> Column:
    """The edits applied to the rows."""
    def made(edit: Column) -> Column:
        row = F.get(rows, edit["source"])
        return F.struct(F.coalesce(edit["role"], row["role"]).alias("role"), F.coalesce(row["text"], F.lit("")).alias("text"))

    return F.transform(edits, made)


def repair(conversations: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """One row per conversation of (conv_id, turn, role, text): gaps, blank, duplicate, truncated, illegal, cost, audit,
    and ``repaired``, its rows (role, text) after the edits.

    ``ids``: conversations (conv_id) to report even if they have no rows.
    """
    rows = _marked(conversations).select("conv_id", F.struct("role", "text", "turn", "blank", "ended").alias("row"))
    if ids is not None:
        rows = rows.unionByName(ids.select("conv_id", F.lit(None).cast(rows.schema["row"].dataType).alias("row")))
    # Sorted by role and text, a repeated row stands behind its earlier copy.
    found = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("row")).alias("sorted"))
    turns = F.col("sorted.turn")
    seen = F.sort_array(let(F.col("sorted"), lambda a: F.transform(a, lambda x, i: F.struct(
        x["turn"].alias("turn"), x["role"].alias("role"), x["text"].alias("text"),
        F.coalesce((F.get(a, i - 1)["role"] == x["role"]) & (F.get(a, i - 1)["text"] == x["text"]), F.lit(False)).alias("seen"),
        x["blank"].alias("blank"), x["ended"].alias("ended")))))
    known = F.filter(turns, lambda t: t.isNotNull())
    found = found.select("conv_id", seen.alias("rows"), F.when(F.size(known) == 0, F.lit(0)).otherwise(
        F.array_max(known) - F.array_min(known) + 1 - F.size(F.array_distinct(known))).cast("long").alias("gaps"))
    found = found.withColumn("symbols", F.array_join(F.transform("rows", _symbol), ""))
    parsed = found.withColumn("parsed", _parse_column()("symbols"))
    rows = F.col("rows")
    pairs = F.when(F.size(rows) > 1, let(F.transform(rows, lambda r: F.substring(r["role"], 1, 1)), lambda a: F.zip_with(
        F.slice(a, F.lit(1), F.greatest(F.size(a) - 1, F.lit(0))), F.slice(a, F.lit(2), F.greatest(F.size(a) - 1, F.lit(0))), lambda x, y: F.concat(x, y)))).otherwise(F.array().cast("array<string>"))
    return parsed.select(
        "conv_id", "gaps", _count(rows, lambda r: r["blank"]).alias("blank"), _count(rows, lambda r: ~r["blank"] & r["seen"]).alias("duplicate"),
        _count(rows, lambda r: ~r["blank"] & ~r["seen"] & ~r["ended"]).alias("truncated"),
        _count(pairs, lambda p: ~p.isin("su", "ua", "au")).alias("illegal"),
        F.col("parsed.cost").alias("cost"), F.col("parsed.audit").alias("audit"), _repaired(rows, F.col("parsed.edits")).alias("repaired"))


def damaged(conversations: DataFrame) -> DataFrame:
    """The given conversations with faults put in by a checksum of conv_id and turn."""
    def key(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    fault = F.crc32(F.concat(key("conv_id"), F.lit(":"), key("turn")).cast("binary")) % 20
    rows = conversations.select("conv_id", F.col("turn").cast("long").alias("turn"), key("role").alias("role"), key("text").alias("text"), fault.alias("fault"))

    def row(role: Column, text: Column) -> Column:
        return F.struct(F.col("turn"), role.alias("role"), text.alias("text"))

    role, text = F.col("role"), F.col("text")
    same = row(role, text)
    made = F.when(F.col("fault") == 0, F.array().cast("array<struct<turn:bigint,role:string,text:string>>")) \
        .when(F.col("fault") == 1, F.array(row(role, F.lit("")))) \
        .when(F.col("fault") == 2, F.array(row(role, F.regexp_replace(text, "[.!?]", "")))) \
        .when(F.col("fault") == 3, F.array(same, same)) \
        .when(F.col("fault") == 4, F.array(row(F.lit("user"), text))).otherwise(F.array(same))
    return rows.select("conv_id", F.inline(made))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Damage all conversations and repair them."""
    given = table(spark, sf_dir, "conversations")
    found = repair(damaged(given), given.select("conv_id").distinct())
    lines = F.array_join(F.transform("repaired", lambda r: F.concat(r["role"], F.lit(":"), r["text"])), "\n")
    return found.withColumn("repaired_sha256", F.sha2(lines, 256)).drop("repaired")
