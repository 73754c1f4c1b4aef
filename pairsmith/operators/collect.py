"""From free-text model replies to idea lists and JSON values.

Each job is one narrow projection in Spark expressions that records which branch read the reply.
Only lists that need the full Python or JSON grammar go through an Arrow function.
"""

from __future__ import annotations

import ast
import json
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pairsmith.functions.binding import let, only_if
from pairsmith.functions.strict_json import parse_closed, parse_strict
from pairsmith.functions.text import SPACE, strip
from pairsmith.operators.sampling import settle
from pairsmith.session import prepare

# The reply shapes that are recognised.
FENCE = r"(?s)```(.*?)```"
JSON_FENCE = r"(?s)```json(.*?)```"
PYTHON_FENCE = r"(?s)```python(.*?)```"
BRACES = r"\{[^}]*+\}"
BRACKETS = r"\[[^\]]*+\]"
COMMA_BEFORE_BRACE = rf"(?U),{SPACE}*+\}}"
COMMA_BEFORE_BRACKET = rf"(?U),{SPACE}*+\]"
UNESCAPED_QUOTES = r'(?s)(?<!\\)"(.*?)(?<!\\)"'
QUOTED = r'"([^"]+)"'
BULLET = rf"(?U)^[-*•]{SPACE}+"
NUMBER = rf"(?U)^\d+\.{SPACE}+"
PLAIN_STRING = r'''"[^"\\\x00-\x1f]*+"|'[^'\\\x00-\x1f]*+\''''
MARK = "\u0001"

PARSED = "struct<parse_branch: string, parsed: variant>"


def matches(text: Column, pattern: str, group: int) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(group))


def _first(candidates: Column, parse, branch: str) -> Column:
    """The first candidate that parses, with the name of its branch."""
    tried = F.transform(candidates, lambda s: F.struct(F.lit(branch).alias("parse_branch"), parse(s).alias("parsed")))
    return F.get(F.filter(tried, lambda t: t["parsed"].isNotNull()), 0)


def _fenced_or_braced(text: Column, prefix: str) -> Column:
    def fenced(mark: str, pattern: str, branch: str) -> Column:
        return F.when(F.instr(text, mark) > 0, _first(matches(text, pattern, 1), parse_strict, prefix + branch))

    return F.coalesce(
        fenced("```", FENCE, "fence"),
        fenced("```json", JSON_FENCE, "json_fence"),
        fenced("```python", PYTHON_FENCE, "python_fence"),
        _first(matches(text, BRACES, 0), parse_closed, prefix + "braces"),
    )


def _json_string(text: Column) -> Column:
    return let(F.to_json(F.array(text)), lambda quoted: F.substring(quoted, F.lit(2), F.length(quoted) - 2))


def _quoted_pairs(text: Column) -> Column:
    """Quoted strings taken as key, value, key, value; the last value of a key wins."""

    def pair_up(strings: Column) -> Column:
        pairs = F.transform(
            F.sequence(F.lit(0), F.size(strings) - 2, F.lit(2)),
            lambda i: F.concat(_json_string(F.get(strings, i)), F.lit(":"), _json_string(F.get(strings, i + 1))),
        )
        value = F.try_parse_json(F.concat(F.lit("{"), F.concat_ws(",", pairs), F.lit("}")))
        even = (F.size(strings) > 0) & (F.size(strings) % 2 == 0)
        return F.when(even, F.struct(F.lit("quoted_pairs").alias("parse_branch"), value.alias("parsed")))

    return let(matches(text, UNESCAPED_QUOTES, 1), pair_up)


def _read_replies(df: DataFrame, output: str, repair: str, replacement: str, read, salvage=None) -> DataFrame:
    prepare(df.sparkSession)
    replies = df.where(F.col(output).isNotNull())

    def second_try(repaired: Column) -> Column:
        branches = [F.when(repaired != F.col(output), read(repaired, "repaired_"))]
        if salvage:
            branches.append(salvage(repaired))
        return F.coalesce(*branches)

    # The repair is only computed for replies that cannot be read as they are.
    branches = [read(F.col(output), ""), let(F.regexp_replace(output, repair, replacement), second_try)]
    nothing = F.struct(F.lit("none").alias("parse_branch"), F.lit(None).cast("variant").alias("parsed"))
    found = replies.withColumn("_found", F.coalesce(*branches, nothing).cast(PARSED))
    return settle(found, ["_found"]).select(*df.columns, "_found.parse_branch", "_found.parsed")


def read_json(df: DataFrame, output: str = "output") -> DataFrame:
    """Add ``parse_branch`` and ``parsed``, the first JSON value of each reply; null if there is none.

    Order: fenced blocks, blocks fenced as json, as python, brace pairs, the same once more
    without trailing commas, and last the quoted strings as key/value pairs. A value that is JSON
    ``null`` ends the search and stays a VARIANT null.
    """
    return _read_replies(df, output, COMMA_BEFORE_BRACE, "}", _fenced_or_braced, _quoted_pairs)


def collect_json(df: DataFrame, output: str = "output") -> DataFrame:
    """The rows of ``read_json`` that hold a value."""
    return read_json(df, output).where(F.col("parsed").isNotNull() & ~F.is_variant_null("parsed"))


def read_list(df: DataFrame, output: str = "output") -> DataFrame:
    """Add ``parse_branch`` and ``parsed``, the first fenced JSON value or bracketed list of each reply."""
    spaced = df.withColumn("_spaced", F.replace(F.col(output), F.lit("\t"), F.lit(" ")))

    def read(text: Column, prefix: str) -> Column:
        return F.coalesce(
            F.when(F.instr(text, "```") > 0, _first(matches(text, FENCE, 1), parse_strict, prefix + "fence")),
            _first(matches(text, BRACKETS, 0), parse_closed, prefix + "brackets"),
        )

    return _read_replies(spaced, "_spaced", COMMA_BEFORE_BRACKET, "]", read).drop("_spaced")


# --- ideas -----------------------------------------------------------------------------------

_IDEAS_TYPE = pa.struct([("parse_branch", pa.string()), ("ideas", pa.list_(pa.string()))])


def _list_of(reply: str) -> dict | None:
    """Items of the first bracket text that is a list, by Python's grammar or else by JSON's."""
    texts = re.findall(r"\[[^\]]*\]", reply)
    for branch, reader in (("python_list", ast.literal_eval), ("json_list", json.loads)):
        for text in texts:
            try:
                value = reader(text)
            except (ValueError, SyntaxError):
                continue
            except Exception:  # too deep, unhashable: this grammar is given up
                break
            items = [str(item).strip().encode("utf-8", "replace").decode() for item in value if item]
            if items:
                return {"parse_branch": branch, "ideas": items}
            break
    return None


@F.arrow_udf(T.StructType().add("parse_branch", T.StringType()).add("ideas", T.ArrayType(T.StringType())))
def _list_by_grammar(replies: pa.Array) -> pa.Array:
    found = [None if reply is None else _list_of(reply) for reply in replies.to_pylist()]
    return pa.array(found, _IDEAS_TYPE)


def _ideas(branch: str, items: Column) -> Column:
    read = F.struct(F.lit(branch).alias("parse_branch"), items.alias("ideas"))
    return only_if(read, lambda r: F.size(r["ideas"]) > 0)


def _not_empty(items: Column) -> Column:
    return F.filter(items, lambda s: s != "")


def _quoted_ideas(text: Column) -> Column:
    return _not_empty(F.transform(matches(text, QUOTED, 1), strip))


def _bulleted_ideas(text: Column) -> Column:
    lines = F.transform(F.split(text, "\n"), strip)
    listed = F.filter(lines, lambda s: s.rlike(BULLET) | s.rlike(NUMBER))
    bare = F.transform(listed, lambda s: F.regexp_replace(F.regexp_replace(s, BULLET, ""), NUMBER, ""))
    return F.transform(_not_empty(bare), strip)


def read_ideas(df: DataFrame, output: str = "output") -> DataFrame:
    """Add ``parse_branch`` and ``ideas``, the list of ideas in each reply (maybe empty).

    Order: bracketed lists, double-quoted strings, bulleted or numbered lines. A single idea is
    split into sentences at full stops.
    """
    text = F.col(output)
    first = F.when(F.instr(text, "[") > 0, F.regexp_extract(text, BRACKETS, 0))
    rows = df.where(text.isNotNull()).withColumn("_first", first)
    # A list of plain quoted strings leaves [mark,mark,...] once its strings are marked.
    skeleton = F.regexp_replace(F.regexp_replace("_first", PLAIN_STRING, MARK), r"[ \t\r\n]++", "")
    is_plain = (F.replace(skeleton, F.lit("," + MARK), F.lit("")) == f"[{MARK}]") & ~F.contains("_first", F.lit(MARK))
    strings = matches(F.col("_first"), PLAIN_STRING, 0)
    items = F.transform(strings, lambda s: F.substring(s, F.lit(2), F.length(s) - 2))
    rows = rows.withColumn("_plain", F.when(is_plain, F.transform(_not_empty(items), strip)))
    # Other bracketed replies need a grammar; all other rows pass null to the Arrow function.
    unread = (F.col("_first") != "") & (F.coalesce(F.size("_plain"), F.lit(0)) <= 0)
    rows = rows.withColumn("_grammar", _list_by_grammar(F.when(unread, text)))
    found = F.coalesce(
        _ideas("python_list", F.col("_plain")),
        F.col("_grammar"),
        _ideas("quoted", _quoted_ideas(text)),
        _ideas("bullets", _bulleted_ideas(text)),
        F.struct(F.lit("none").alias("parse_branch"), F.array().cast("array<string>").alias("ideas")),
    )
    rows = settle(rows.withColumn("_found", found).drop("_first", "_plain", "_grammar"), ["_found"])
    single = F.when(F.size("_found.ideas") == 1, F.get("_found.ideas", F.lit(0)))
    sentences = _not_empty(F.transform(F.split(single, r"\."), strip))
    ideas = F.coalesce(only_if(sentences, lambda s: F.size(s) > 1), F.col("_found.ideas"))
    rows = rows.select(*df.columns, "_found.parse_branch", ideas.alias("ideas"))
    return settle(rows, ["parse_branch", "ideas"])


def collect_ideas(df: DataFrame, output: str = "output") -> DataFrame:
    """One row per idea, next to the columns of its reply."""
    return read_ideas(df, output).select(*df.columns, "parse_branch", F.explode("ideas").alias("idea"))


def distinct_ideas(df: DataFrame, output: str = "output") -> DataFrame:
    """Every idea once, over all replies."""
    return collect_ideas(df, output).select("idea").dropDuplicates(["idea"])
