"""Weighted draws of prompt arguments, one narrow projection over the row ids."""

from __future__ import annotations

import math
import random
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pairsmith.functions import random_draw
from pairsmith.functions.binding import let
from pairsmith.functions import template as tpl
from pairsmith.operators.alias import alias_table
from pairsmith.operators.ordering import join_to_unique
from pairsmith.operators.schema import PromptSchema
from pairsmith.sources.value_list import ValueList

INLINE_VALUES = 10_000        # longer lists are joined by index instead of inlined
MOST_TERMS = 1000             # of the weight of later arguments, in a group of tied ones; seven that all differ have 225
SEPARATOR = "\u001f"


def number_array(numbers, kind: str) -> Column:
    """A numeric array literal; Catalyst folds the split into one constant."""
    return F.split(F.lit(",".join(repr(x) for x in numbers)), ",").cast(f"array<{kind}>")


def string_array(values: list[str]) -> Column:
    if any(SEPARATOR in v for v in values):
        return F.array(*[F.lit(v) for v in values])
    return F.split(F.lit(SEPARATOR.join(values)), SEPARATOR)


@dataclass
class Weights:
    """Probabilities of a list with their running sum, whose last entry is exactly 1."""

    p: np.ndarray
    cdf: np.ndarray

    @classmethod
    def of(cls, p) -> Weights:
        p = np.asarray(p, dtype=np.float64)
        cdf = np.cumsum(p)
        cdf = cdf / cdf[-1]
        last = int(np.flatnonzero(p)[-1])
        cdf[last:] = 1.0
        return cls(p / p.sum(), cdf)

    @classmethod
    def uniform(cls, length: int) -> Weights:
        return cls(np.full(length, 1.0 / length), np.arange(1, length + 1) / length)

    def index(self, u: Column) -> Column:
        """The first ``i`` with ``u < cdf[i]``.

        A table of starting points cuts [0, 1) into equal slices; with enough slices only a few
        steps remain in most of them. The rest is a binary search over the steps of the widest
        slice, each of its stages one look into the running sum. ``u`` should be a plain column.
        """
        slices = 1 << max(8, math.ceil(math.log2(4 * len(self.cdf))))
        edges = np.arange(slices + 1) / slices
        start = np.searchsorted(self.cdf, edges[:-1], side="right")
        steps = int((np.searchsorted(self.cdf, edges[1:], side="left") - start).max())
        cdf = number_array(self.cdf.tolist(), "double")
        index = F.get(number_array(start.tolist(), "int"), F.floor(u * slices).cast("int"))
        for bit in reversed(range(steps.bit_length())):
            step = 1 << bit  # ``let`` uses the body at once
            index = let(index, lambda i: i + F.when(F.get(cdf, i + (step - 1)) <= u, step).otherwise(0))  # noqa: B023
        return index


def uniform_index(u: Column, length: int) -> Column:
    kind = "int" if length < 2**31 else "long"
    return F.floor(u * length).cast(kind)


@dataclass
class Argument:
    name: str
    values: list | ValueList
    weights: Weights | None

    def __len__(self) -> int:
        return len(self.values)

    @property
    def in_table(self) -> bool:
        """Whether the weights are a column of the list."""
        return isinstance(self.values, ValueList) and self.values.weighted and self.weights is None

    def index(self, u: Column) -> Column:
        return self.weights.index(u) if self.weights else uniform_index(u, len(self))

    def known_weights(self) -> Weights:
        return self.weights or Weights.uniform(len(self))


def _arguments(schema: PromptSchema) -> dict[str, Argument]:
    return {
        name: Argument(name, values, Weights.of(schema.args_p[name]) if name in schema.args_p else None)
        for name, values in schema.args.items()
    }


def _components(schema: PromptSchema) -> list[tuple[list[str], set[tuple[str, str]]]]:
    """Groups of arguments tied together by constraints, with their unequal pairs."""
    groups: list[tuple[set[str], set[tuple[str, str]]]] = []
    for c in schema.constraints or []:
        a, b = c["value1"], c["value2"]
        if a == b:
            raise ValueError(f"no samples can meet the constraint {c}")
        names, pairs = {a, b}, {tuple(sorted((a, b)))}
        for group in [g for g in groups if g[0] & names]:
            groups.remove(group)
            names |= group[0]
            pairs |= group[1]
        groups.append((names, pairs))
    order = list(schema.args)
    return [(sorted(names, key=order.index), pairs) for names, pairs in groups]


def draw_pair(df: DataFrame, first: Argument, second: Argument, seed: int) -> DataFrame:
    """Two indices that differ, in one draw each and without rejection.

    Rejecting equal pairs leaves P(s, t) = p_s q_t / Z for s != t. That is the same as drawing s
    with weight p_s (1 - q_s), and then t by its own weights with s cut out of the line [0, 1).
    """
    p, q = first.known_weights(), second.known_weights()
    length = len(first)
    q_of = np.zeros(length)
    q_of[: min(length, len(second))] = q.p[:length]
    ends = np.ones(length)
    ends[: min(length, len(second))] = q.cdf[:length]
    weight = p.p * (1.0 - q_of)
    weight[q_of >= 1.0] = 0.0
    if weight.sum() <= 0:
        raise ValueError(f"no samples can meet the constraint {first.name} != {second.name}")
    # Where rounding would still land on s, use a neighbour that has weight.
    usable = np.flatnonzero(q.p > 0)
    other = [int(usable[usable != s][-1]) if (usable != s).any() else 0 for s in usable]
    spare = np.full(length, int(usable[-1]))
    for s, o in zip(usable, other):
        if s < length:
            spare[s] = o
    df = df.withColumns({
        "_u1": random_draw.uniform(seed, first.name, F.col("id")),
        "_u2": random_draw.uniform(seed, second.name, F.col("id")),
    })
    df = df.withColumn("_s", Weights.of(weight / weight.sum()).index(F.col("_u1")))
    df = df.withColumns({
        "_qs": F.get(number_array(q_of.tolist(), "double"), F.col("_s")),
        "_end": F.get(number_array(ends.tolist(), "double"), F.col("_s")),
    })
    line = F.col("_u2") * (1.0 - F.col("_qs"))
    jump = F.least(F.greatest(line + F.col("_qs"), F.col("_end")), F.lit(1.0 - 2**-53))
    df = df.withColumn("_v", F.when((F.col("_qs") > 0) & (line >= F.col("_end") - F.col("_qs")), jump).otherwise(line))
    df = df.withColumn("_t", q.index(F.col("_v")))
    clash = F.col("_t") == F.col("_s")
    return df.withColumns({
        f"_idx_{first.name}": F.col("_s"),
        f"_idx_{second.name}": F.when(clash, F.get(number_array(spare.tolist(), "int"), F.col("_s"))).otherwise(F.col("_t")),
    }).drop("_u1", "_u2", "_s", "_qs", "_end", "_v", "_t")


@dataclass
class Term:
    """A product of one vector per argument (each read at that argument's index) where some indices are equal."""

    vectors: dict[int, np.ndarray]
    equal: frozenset[tuple[int, int]] = frozenset()


def _merged(terms: list[Term]) -> list[Term]:
    """Terms that differ in the vector of one argument only are one term with the sum of the vectors."""
    found: dict[tuple, Term] = {}
    for t in terms:
        if any(not v.any() for v in t.vectors.values()):
            continue
        last = max(t.vectors, default=-1)
        key = t.equal, last, tuple((k, t.vectors[k].tobytes()) for k in sorted(t.vectors) if k != last)
        if key not in found:
            found[key] = t
        elif last >= 0:
            found[key] = Term({**t.vectors, last: found[key].vectors[last] + t.vectors[last]}, t.equal)
    return list(found.values())


def _padded(vector: np.ndarray, length: int) -> np.ndarray:
    """A vector read at another argument's index: 0 beyond its own end."""
    out = np.zeros(length)
    out[:min(length, len(vector))] = vector[:length]
    return out


def eliminate(terms: list[Term], j: int, p: list[np.ndarray], tied: list[set[int]]) -> list[Term]:
    """Sum argument ``j`` out of a sum of terms, weighted by its probabilities and unequal to the earlier arguments it is
    tied to. What is left depends on the indices of those arguments only."""
    before = sorted(a for a in tied[j] if a < j)
    out = []
    for t in terms:
        own = p[j] * t.vectors.get(j, 1.0)
        rest = {a: v for a, v in t.vectors.items() if a != j}
        same = {a if b == j else b for a, b in t.equal if j in (a, b)}
        others = frozenset(e for e in t.equal if j not in e)
        if same & set(before):
            continue  # equal to an argument that it must differ from
        # The product of (1 - [x_j = x_a]) over the tied arguments a, spelt out by the set that equals x_j. Two that are tied
        # to each other are never equal, so the sets are small.
        sets = [frozenset()]
        for a in before:
            sets += [s | {a} for s in sets if not any(b in tied[a] for b in s | same)]
        for s in sets:
            at = sorted(s | same)
            sign = -1.0 if len(s) % 2 else 1.0
            vectors = dict(rest)
            if at:
                a = at[0]
                vectors[a] = vectors.get(a, 1.0) * sign * _padded(own, len(p[a]))
            else:
                a = min(rest, default=0)
                vectors[a] = vectors.get(a, np.ones(len(p[a]))) * (sign * own.sum())
            equal = {tuple(sorted((at[0], b))) for b in at[1:]} | others
            if not any(b in tied[a] for a, b in equal):
                out.append(Term(vectors, frozenset(equal)))
    merged = _merged(out)
    if len(merged) > MOST_TERMS:
        raise ValueError("too many arguments are tied to each other")
    return merged


def _possible(p: list[np.ndarray], tied: list[set[int]]) -> bool:
    """Whether any choice of indices with positive weight meets all constraints."""
    left, core = set(range(len(p))), True
    while core:  # an argument with more values than ties can always be chosen last
        core = {j for j in left if np.count_nonzero(p[j]) > len(tied[j] & left)}
        left -= core
    order, values = sorted(left), {j: np.flatnonzero(p[j]).tolist() for j in left}

    def go(i: int, chosen: dict[int, int]) -> bool:
        if i == len(order):
            return True
        j = order[i]
        return any(go(i + 1, {**chosen, j: v}) for v in values[j] if all(chosen.get(a) != v for a in tied[j]))

    return go(0, {})


def draw_tied(df: DataFrame, members: list[Argument], pairs: set[tuple[str, str]], seed: int) -> DataFrame:
    """Indices of arguments that are tied by constraints, drawn one after the other without rejection.

    Argument j is drawn from its exact distribution given the earlier ones: the weight of index v is its probability
    times the total weight of all later arguments, given v and the indices drawn so far. That total is a sum of products
    of vectors, found by eliminating the last argument, then the one before it, and so on. Running sums of its vectors
    make the running sum of the weights one look-up per term, so a binary search finds the index.
    """
    names = [m.name for m in members]
    p = [m.known_weights().p for m in members]
    tied: list[set[int]] = [set() for _ in members]
    for a, b in pairs:
        tied[names.index(a)].add(names.index(b))
        tied[names.index(b)].add(names.index(a))
    if not _possible(p, tied):
        raise ValueError("no samples found that meet the constraints")
    later: list[list[Term]] = [[Term({})]]
    for j in range(len(members) - 1, 0, -1):
        later.insert(0, eliminate(later[0], j, p, tied))
    for j, member in enumerate(members):
        df = _draw_given(df, j, member, p[j], later[j], sorted(a for a in tied[j] if a < j), seed)
    return df.select(*[c for c in df.columns if not c.startswith("_x")], *[F.col(f"_x{j}").alias(f"_idx_{m.name}") for j, m in enumerate(members)])


def _at(vector: np.ndarray, index: Column) -> Column:
    """A vector at an index, 0 outside of it."""
    return F.coalesce(F.get(number_array(vector.tolist(), "double"), index), F.lit(0.0))


def _draw_given(df: DataFrame, j: int, member: Argument, p: np.ndarray, terms: list[Term], unequal: list[int], seed: int) -> DataFrame:
    """Add ``_x{j}``, given the columns of the earlier arguments."""
    kept, n = df.columns, len(p)
    factors, points = [], []
    for t in terms:
        factor = F.lit(1.0)
        for a, v in t.vectors.items():
            if a != j:
                factor = factor * _at(v, F.col(f"_x{a}"))
        for a, b in t.equal:
            if j not in (a, b):
                factor = F.when(F.col(f"_x{a}") == F.col(f"_x{b}"), factor).otherwise(0.0)
        own = p * t.vectors.get(j, np.ones(n))
        same = [a if b == j else b for a, b in t.equal if j in (a, b)]
        if same:  # weight at one index only
            for a in same[1:]:
                factor = F.when(F.col(f"_x{a}") == F.col(f"_x{same[0]}"), factor).otherwise(0.0)
            points.append((factor * _at(own, F.col(f"_x{same[0]}")), F.col(f"_x{same[0]}")))
        else:
            factors.append((factor, own))
    df = df.withColumn("_u", random_draw.uniform(seed, member.name, F.col("id")))
    df = settle(df.withColumns({f"_f{i}": f for i, (f, _) in enumerate(factors)} | {f"_g{i}": g for i, (g, _) in enumerate(points)}),
                ["_u", *(f"_f{i}" for i in range(len(factors))), *(f"_g{i}" for i in range(len(points)))])

    def weight(index: Column) -> Column:
        return sum((F.col(f"_f{i}") * _at(own, index) for i, (_, own) in enumerate(factors)), F.lit(0.0))

    # Indices that an earlier argument has taken, each once, with the weight they would have had.
    taken = []
    for place, a in enumerate(unequal):
        first = F.lit(True)
        for b in unequal[:place]:
            first = first & (F.col(f"_x{a}") != F.col(f"_x{b}"))
        taken.append(F.when(first, weight(F.col(f"_x{a}"))).otherwise(0.0))
    df = settle(df.withColumns({f"_t{i}": t for i, t in enumerate(taken)}), [f"_t{i}" for i in range(len(taken))])

    def up_to(index: Column) -> Column:
        """Weight of all indices up to ``index``."""
        total = sum((F.col(f"_f{i}") * F.get(number_array(np.cumsum(own).tolist(), "double"), F.least(index, F.lit(n - 1))) for i, (_, own) in enumerate(factors)), F.lit(0.0))
        for i, a in enumerate(unequal):
            total = total - F.when(F.col(f"_x{a}") <= index, F.col(f"_t{i}")).otherwise(0.0)
        for i, (_, at) in enumerate(points):
            total = total + F.when(at <= index, F.col(f"_g{i}")).otherwise(0.0)
        return total

    df = settle(df.withColumn("_y", F.col("_u") * up_to(F.lit(n - 1))), ["_y"])
    halves = F.array(*[F.lit(1 << b) for b in reversed(range((n - 1).bit_length()))])
    found = F.aggregate(halves, F.lit(0), lambda i, step: F.when((i + step <= n - 1) & (up_to(i + step - 1) <= F.col("_y")), i + step).otherwise(i)) if n > 1 else F.lit(0)
    # Where rounding ends on an index that is taken or has no weight, the next one that is free is meant.
    follows = np.flatnonzero(p)[np.searchsorted(np.flatnonzero(p), np.arange(n), side="right") % np.count_nonzero(p)]

    def moved_on(index: Column) -> Column:
        barred = F.get(number_array((p > 0).astype(int).tolist(), "int"), index) == 0
        for a in unequal:
            barred = barred | (F.col(f"_x{a}") == index)
        return F.when(barred, F.get(number_array(follows.tolist(), "int"), index)).otherwise(index)

    for _ in range(len(unequal) + 1):
        found = let(found, moved_on)
    return settle(df.withColumn(f"_x{j}", found), [f"_x{j}"]).select(*kept, f"_x{j}")


def draw_from_table(df: DataFrame, argument: Argument, seed: int) -> DataFrame:
    """Index and value by one join on a slot of the list's alias table; slots are drawn evenly, whatever the weights."""
    name = argument.name
    slots = alias_table(argument.values.df, len(argument)).withColumnRenamed("slot", "_slot")
    rows = df.withColumns({
        "_slot": F.floor(random_draw.uniform(seed, name, F.col("id")) * len(argument)).cast("long"),
        "_place": random_draw.uniform(seed, name, F.col("id"), 1),
    })
    kept = F.col("_place") < F.col("keeps")
    return rows.join(slots, "_slot").select(
        *df.columns, F.when(kept, F.col("_slot")).otherwise(F.col("other")).alias(f"_idx_{name}"),
        F.when(kept, F.col("value")).otherwise(F.col("other_value")).alias(f"_val_{name}"))


def draw_indices(df: DataFrame, schema: PromptSchema, seed: int) -> DataFrame:
    """Add ``_idx_<arg>`` for every argument to a table that has an ``id``."""
    arguments = _arguments(schema)
    tied: set[str] = set()
    for names, pairs in _components(schema):
        tied |= set(names)
        members = [arguments[n] for n in names]
        for m in members:
            if m.in_table:
                raise ValueError(f"weights in a table can't be used with a constraint on {m.name!r}")
        df = draw_pair(df, *members, seed) if len(members) == 2 else draw_tied(df, members, pairs, seed)
    for a in arguments.values():
        if a.in_table:
            df = draw_from_table(df, a, seed)
    free = [a for a in arguments.values() if a.name not in tied and not a.in_table]
    if free:
        df = df.withColumns({f"_u_{a.name}": random_draw.uniform(seed, a.name, F.col("id")) for a in free})
        df = df.withColumns({f"_idx_{a.name}": a.index(F.col(f"_u_{a.name}")) for a in free})
        df = df.drop(*[f"_u_{a.name}" for a in free])
    return settle(df, [f"_idx_{name}" for name in arguments])


def settle(df: DataFrame, names: list[str]) -> DataFrame:
    """Pass computed columns through a one-row generator.

    Catalyst pushes a later filter below a projection and then computes the filtered columns twice,
    once per nested use. It does not push filters below a generator.
    """
    if not names:
        return df
    others = [c for c in df.columns if c not in names]
    return df.select(*others, F.inline(F.array(F.struct(*names))))


def constraint_filter(df: DataFrame, constraints: list[dict[str, str]] | None, prefix: str = "_idx_") -> DataFrame:
    """Keep rows whose index columns meet every constraint. Indices are compared, not values."""
    for c in constraints or []:
        df = df.where(F.col(prefix + c["value1"]) != F.col(prefix + c["value2"]))
    return df


def _attach_values(df: DataFrame, argument: Argument) -> DataFrame:
    """Replace ``_idx_<arg>`` by the value."""
    index, target = f"_idx_{argument.name}", f"_val_{argument.name}"
    if argument.in_table:
        return df.drop(index)
    values = argument.values
    if isinstance(values, list) and len(values) > INLINE_VALUES:
        spark = df.sparkSession
        values = ValueList(spark.createDataFrame(list(enumerate(map(str, values))), "idx long, value string"), len(values))
    if isinstance(values, list):
        return df.withColumn(target, F.get(string_array([str(v) for v in values]), F.col(index))).drop(index)
    dim = values.df.select(F.col("idx").cast("long").alias(index), F.col("value").alias(target))
    rows = df.withColumn(index, F.col(index).cast("long"))
    hot: list[int] = []
    if argument.weights is not None:
        heavy = np.flatnonzero(argument.weights.p > 1e-3)  # fewer than 1000 of them
        if len(heavy):
            spark = df.sparkSession
            ids = spark.createDataFrame([(int(i),) for i in heavy], f"{index} long")
            hot = [r["h"] for r in ids.select(F.xxhash64(index).alias("h")).collect()]
    # Spark broadcasts the list if it is small enough for that, and shuffles both sides otherwise.
    found = join_to_unique(rows, dim.withColumn("_known", F.lit(True)), [index], "id", hot)
    missing = F.raise_error(F.lit(f"the list of {argument.name} has no value for an index that was drawn"))
    return found.withColumn(target, F.when(F.col("_known"), F.col(target)).otherwise(missing)).drop(index, "_known")


def draw_values(ids: DataFrame, schema: PromptSchema, seed: int) -> DataFrame:
    """Add ``sample`` (a struct of the drawn values) and ``formatted_prompt`` to a table of ids."""
    schema = schema.resolve(ids.sparkSession)
    names = list(schema.args)
    keep = ids.columns
    df = draw_indices(ids, schema, seed)
    for argument in _arguments(schema).values():
        df = _attach_values(df, argument)
    values = {name: F.col(f"_val_{name}") for name in names}
    sample_column = F.struct(*[values[n].alias(n) for n in names]) if names else F.lit(None).cast("map<string,string>")
    return df.select(*keep, sample_column.alias("sample"), tpl.render(schema.prompt_template, values).alias("formatted_prompt"))


def sample(spark: SparkSession, schema: PromptSchema, n: int, seed: int | None = None) -> DataFrame:
    """Exactly ``n`` rows ``(id, sample, formatted_prompt)``; the same for a seed on any partitioning."""
    if seed is None:
        seed = random.SystemRandom().getrandbits(31)
    return draw_values(spark.range(n), schema, seed)
