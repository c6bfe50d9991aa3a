"""Text functions as Column expressions; only the bracket matcher needs Python."""

from __future__ import annotations

import functools
import json
import operator
import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that results depend on.
REASONING_WORDS = ["how", "why", "explain", "analyze", "compare", "evaluate", "design"]
REASONING_PARTS = ["trade-off", "optimize", "architecture", "mechanism", "relationship"]
STRUCTURE_MARKS = ["1.", "2.", "- ", "• ", "First", "Second"]
PENALTY_KEYWORDS = [
    "workflow", "github actions", "ci/cd", "pipeline", "cmake", "build system", "test script",
    "runs on", "devcontainer", "ubuntu-latest", "windows-latest", "workflow trigger", "job depend", "build step",
]
CHAIN_WORDS = ["then", "after", "next", "also", "and then", "first", "second", "finally", "both", "combine", "use the result", "based on", "followed by"]
REASONING_MARKS = ["step 1:", "let me think", "let's break this down", "first,", "to answer this"]
FINAL_MARKS = ["\ntherefore", "\nso,", "\nin conclusion", "\nfinal answer:", "\nanswer:"]


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def words(text: Column | str) -> Column:
    """Tokens between white space."""
    return F.filter(F.split(_col(text), r"\s+"), lambda w: w != "")


def contains_any(text: Column | str, parts: list[str]) -> Column:
    return F.exists(F.array(*[F.lit(p) for p in parts]), lambda p: F.contains(_col(text), p))


def count_contained(texts: list[Column | str], parts: list[str]) -> Column:
    """How many of ``parts`` occur in at least one of the texts, in lower case."""
    lows = [F.lower(F.coalesce(_col(t), F.lit(""))) for t in texts]
    hit = lambda p: F.array_contains(F.array(*[F.contains(t, p) for t in lows]), True)
    return F.size(F.filter(F.array(*[F.lit(p) for p in parts]), hit))


def sanitise_chunk(text: Column | str) -> Column:
    """Double quotes in code that models tend to echo, as single quotes."""
    out = F.regexp_replace(_col(text), r'\["([^"]+)"\]', "['$1']")
    out = F.regexp_replace(out, r'f"([^"]*)"', "f'$1'")
    out = F.regexp_replace(out, r'Exception\("([^"]*)"\)', "Exception('$1')")
    return F.regexp_replace(out, r'\("([^"]{1,50})"\)', "('$1')")


def clean_json(raw: Column | str) -> Column:
    """Byte-order mark, trailing and double commas gone; cut to the outermost square brackets."""
    out = F.regexp_replace(F.regexp_replace(_col(raw), r"^[\s\uFEFF]+|\s+$", ""), r",([\]}])", "$1")
    out = F.regexp_replace(out, r",\s*,", ",")
    out = F.when(F.contains(out, F.lit("[")), F.substring(out, F.instr(out, "["), F.length(out))).otherwise(out)
    last = F.length(out) - F.instr(F.reverse(out), "]") + 1
    return F.when(F.contains(out, F.lit("]")), F.substring(out, F.lit(1), last)).otherwise(out)


_LAX = {"allowSingleQuotes": "true", "allowUnquotedFieldNames": "true", "allowComments": "true", "allowBackslashEscapingAnyCharacter": "true"}


def parse_json(raw: Column | str, schema: str) -> Column:
    """Lenient JSON, tried in turn: as it came if it is a strict array, as cleaned, inner quotes after words, then in all brackets, then as it came.

    The first reading with at least one entry counts; null if none has.
    """
    from pyspark.sql.types import _parse_datatype_string

    clean = clean_json(raw)
    # Cleaning would change commas within the strings of what is sound.
    sound = F.when(F.startswith(F.ltrim(_col(raw)), F.lit("[")) & F.try_parse_json(_col(raw)).isNotNull(), _col(raw))
    fixed = [sound, clean, F.regexp_replace(clean, r'(?<=\w)\["([^"]+)"\]', "['$1']"), F.regexp_replace(clean, r'\["([^"]+)"\]', "['$1']"), _col(raw)]
    lax = _LAX | {"mode": "PERMISSIVE"}
    names = _parse_datatype_string(schema).elementType.fieldNames()
    told = lambda e: functools.reduce(operator.or_, [e[n].isNotNull() for n in names])
    # An array of one reading, so that each is made once and the next one only where it is empty.
    good = [F.get(F.filter(F.array(F.filter(F.from_json(x, schema, lax), told)), lambda g: F.size(g) > 0), 0) for x in fixed]
    return F.coalesce(*good)


def strip_fence(raw: Column | str) -> Column:
    """What a code fence at the start encloses, otherwise the text itself, trimmed."""
    text = F.regexp_replace(_col(raw), r"^\s+|\s+$", "")
    inner = F.regexp_extract(text, r"(?s)^```(?:json)?(.*?)(?:```.*)?$", 1)
    return F.when(F.startswith(text, F.lit("```")), F.regexp_replace(inner, r"^\s+|\s+$", "")).otherwise(text)


def rescue_enriched(raw: Column | str) -> Column:
    """The object with an enriched answer that is somewhere in the text; empty if none."""
    return F.regexp_extract(_col(raw), r'\{[^{}]*"enriched_answer"[^{}]*\}', 0)


def find_json(raw: Column | str) -> Column:
    """The longest run from an opening to a closing bracket; empty if none."""
    return F.regexp_extract(_col(raw), r"(?s)[\[{].*[\]}]", 0)


def matching_array(text: str | None) -> str | None:
    """The first array of the text, its brackets matched outside strings; null if it never closes."""
    if text is None or (start := text.find("[")) < 0:
        return None
    depth, quoted, escaped = 0, False, False
    for i in range(start, len(text)):
        c = text[i]
        if escaped:
            escaped = False
        elif c == "\\":
            escaped = True
        elif c == '"':
            quoted = not quoted
        elif not quoted and c in "[]":
            depth += 1 if c == "[" else -1
            if not depth:
                return text[start : i + 1]
    return None


def parse_conversations(text: str | None) -> str | None:
    """A model's list of conversations as strict JSON: fence, brackets, trailing commas, escaped quotes."""
    if text is None:
        return None
    body = re.sub(r"^```(?:json)?(.*?)(?:```.*)?$", r"\1", text.strip(), flags=re.S).strip()
    found = matching_array(body)
    tries = [found, found and re.sub(r",\s*([}\]])", r"\1", found), found and found.replace('\\"', "'"), body]
    for candidate in tries:
        try:
            value = json.loads(candidate) if candidate else None
        except ValueError:
            continue
        if isinstance(value, list) and value:
            return json.dumps(value, ensure_ascii=False)
    return None


def parse_conversations_udf():
    """``parse_conversations`` over Arrow batches, the one text function that SQL cannot express."""

    @F.pandas_udf("string")
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(parse_conversations)

    return run


def split_reasoning(content: Column | str) -> Column:
    """``struct(reasoning, answer)``: cut at the last final mark, if there are marks of reasoning.

    The answer loses as many characters as its mark has with its line feed.
    """
    text = _col(content)
    low = F.lower(text)
    at = [F.when(F.contains(low, F.lit(m)), F.length(low) - F.length(F.substring_index(low, m, -1)) - len(m)).otherwise(F.lit(-1)) for m in FINAL_MARKS]
    cut = F.greatest(*at)
    trim = lambda c: F.regexp_replace(c, r"^\s+|\s+$", "")
    tail = trim(F.substring(text, cut + 1, F.length(text)))
    bare = F.coalesce(*[F.when(F.startswith(F.lower(tail), F.lit(m.strip())), trim(F.substring(tail, F.lit(len(m) + 1), F.length(tail)))) for m in FINAL_MARKS], tail)
    pair = lambda r, a: F.struct(r.alias("reasoning"), a.alias("answer"))
    return F.when(~contains_any(low, REASONING_MARKS), pair(F.lit(""), text)).when(cut > 0, pair(trim(F.substring(text, F.lit(1), cut)), bare)).otherwise(pair(text, text))


def complexity(question: Column | str) -> Column:
    """4, two more for a reasoning word, one for a technical part, one for over 20 words; 1 to 10."""
    low = F.lower(_col(question))
    score = F.lit(4) + F.when(F.arrays_overlap(words(low), F.array(*[F.lit(w) for w in REASONING_WORDS])), 2).otherwise(0)
    score = score + F.when(contains_any(low, REASONING_PARTS), 1).otherwise(0) + F.when(F.size(words(question)) > 20, 1).otherwise(0)
    return F.greatest(F.lit(1), F.least(F.lit(10), score))


def quality(question: Column | str, answer: Column | str) -> Column:
    """By the answer's length in words, against the question's, and marks of structure; 1 to 10."""
    q, a = F.size(words(question)), F.size(words(answer))
    score = F.when(a < 10, 4).when(a < 30, 6).otherwise(7) - F.when(F.coalesce(F.try_divide(a, q), F.lit(0)) < 0.5, 1).otherwise(0)
    score = score + F.when(contains_any(answer, STRUCTURE_MARKS), 1).otherwise(0)
    return F.greatest(F.lit(1), F.least(F.lit(10), score))


def needs_several_steps(instruction: Column | str, tool_names: list[str]) -> Column:
    """``multi`` where a chaining word or two tool names occur, otherwise ``single``."""
    low = F.lower(_col(instruction))
    named = count_contained([instruction], [n.lower() for n in tool_names]) if tool_names else F.lit(0)
    return F.when(contains_any(low, CHAIN_WORDS) | (named >= 2), "multi").otherwise("single")


def pairs_per_chunk(target: Column | str, chunks: Column | str) -> Column:
    """``target / chunks`` rounded half to even, at least one."""
    return F.greatest(F.lit(1), F.bround(_col(target) / _col(chunks)).cast("int"))


def duration(seconds: Column | str) -> Column:
    """``Hh Mm Ss``, without hours below one."""
    s = F.floor(_col(seconds))
    h, m, r = F.floor(s / 3600), F.floor(s % 3600 / 60), s % 60
    return F.when(h > 0, F.concat(h, F.lit("h "), m, F.lit("m "), r, F.lit("s"))).otherwise(F.concat(m, F.lit("m "), r, F.lit("s")))


def verdict_score(judgment: Column | str) -> Column:
    """The number before a slash on the first line with ``SCORE:``; null if there is none."""
    return F.trim(F.regexp_extract(_col(judgment), r"SCORE:([^/\n:]*)", 1)).try_cast("double")


def verdict_winner(decision: Column | str) -> Column:
    """What follows ``WINNER:`` on its first line."""
    return F.nullif(F.trim(F.regexp_extract(_col(decision), r"WINNER:([^\n]*)", 1)), F.lit(""))


def think_wrap(reasoning: Column | str, answer: Column | str, prefixes: list[str]) -> Column:
    """Reasoning without boilerplate in think tags before the answer; the plain answer where there is none."""
    bare = _col(reasoning)
    for p in prefixes:
        bare = F.replace(bare, F.lit(p), F.lit(""))
    bare = F.trim(bare)
    return F.when(F.coalesce(bare, F.lit("")) == "", _col(answer)).otherwise(F.concat(F.lit("<think>\n"), bare, F.lit("\n</think>\n\n"), _col(answer)))
