"""Chat formatting: heterogeneous layouts to canonical turns to one template.

The layout of a record is recognised by schema fingerprinting: the nested
field paths that it has, in sorted order, are hashed, and the hash selects a
declarative mapping (an SQL expression that makes an array of role and text).
Only a layout's own paths are hashed for it, so fields of other layouts do no
more harm than unknown ones. A record that fits several layouts gets the first
of RECORD_LAYOUTS whose required fields all hold a value, else the first whose
required fields are there. Typed tables are fingerprinted by their schema, JSON records row by row.
Everything is native DataFrame and SQL work.

Template, one turn after the other: ``### <role>: <text></turn>\\n``. Inside
roles and texts a backslash goes before every backslash, ``#`` and ``<`` (in
roles also ``:``), so no control string survives in a text and taking the
backslashes off again gives the text back. The loss mask covers the escaped
texts of assistant turns: ``pieces`` joined give ``formatted``, and ``loss``
says for each piece whether it is trained on.

Edge cases: null text and null role are empty; ties in the turn number are
ordered by role, then text; repeated rows are turns of their own; a null
conversation id is one conversation; records of unknown layout have null
turns; fields that no mapping names are ignored, so extra columns do no harm;
empty tables give an empty result. A conversation is one output row, so its
turns meet in one task: the longest conversation, not the table, bounds that.
"""

from __future__ import annotations

from itertools import combinations

import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TURN = "array<struct<role:string,text:string>>"
_PAIR = "array(named_struct('role', 'user', 'text', {0}), named_struct('role', 'assistant', 'text', {1}))"
_WITH_SYSTEM = "concat(if({s} is null, array(), array(named_struct('role', 'system', 'text', {s}))), {rest})"
_SPOKEN = ("transform(variant_get(v, '{path}', '{kind}'), m -> named_struct('role', "
           "case m.{role} when 'human' then 'user' when 'gpt' then 'assistant' else m.{role} end, 'text', m.{text}))")


def _field(path: str) -> str:
    return f"variant_get(v, '{path}', 'string')"


#: Layouts: (required paths, optional paths, mapping over the variant v).
RECORD_LAYOUTS = [
    (("$.messages[0].content", "$.messages[0].role"), ("$.system",), _WITH_SYSTEM.format(
        s=_field("$.system"), rest=_SPOKEN.format(path="$.messages", kind="array<struct<role:string,content:string>>",
                                                  role="role", text="content"))),
    (("$.conversations[0].from", "$.conversations[0].value"), ("$.system",), _WITH_SYSTEM.format(
        s=_field("$.system"), rest=_SPOKEN.format(path="$.conversations", kind="array<struct<from:string,value:string>>",
                                                  role="`from`", text="value"))),
    (("$.completion", "$.prompt"), ("$.system",), _WITH_SYSTEM.format(
        s=_field("$.system"), rest=_PAIR.format(_field("$.prompt"), _field("$.completion")))),
    (("$.prompt", "$.response"), ("$.system",), _WITH_SYSTEM.format(
        s=_field("$.system"), rest=_PAIR.format(_field("$.prompt"), _field("$.response")))),
    (("$.answer", "$.question"), ("$.system",), _WITH_SYSTEM.format(
        s=_field("$.system"), rest=_PAIR.format(_field("$.question"), _field("$.answer")))),
    (("$.instruction", "$.output"), ("$.input", "$.system"), _WITH_SYSTEM.format(
        s=_field("$.system"), rest=_PAIR.format(
            f"concat_ws('\\n', {_field('$.instruction')}, nullif({_field('$.input')}, ''))", _field("$.output")))),
    (("$.role", "$.text"), (), f"array(named_struct('role', {_field('$.role')}, 'text', {_field('$.text')}))"),
]
#: The same for typed tables: one row is one turn.
ROW_LAYOUTS = {
    ("$.role", "$.text"): "array(named_struct('role', cast(role as string), 'text', cast(text as string)))",
    ("$.content", "$.role"): "array(named_struct('role', cast(role as string), 'text', cast(content as string)))",
    ("$.from", "$.value"): "array(named_struct('role', cast(`from` as string), 'text', cast(value as string)))",
    ("$.completion", "$.prompt"): _PAIR.format("cast(prompt as string)", "cast(completion as string)"),
    ("$.instruction", "$.output"): _PAIR.format("cast(instruction as string)", "cast(output as string)"),
}


def path_fingerprint(paths: tuple[str, ...]) -> int:
    """XXH64 (seed 42, signed) of the sorted paths; the value of Spark's xxhash64 on their join."""
    h = xxhash.xxh64_intdigest(",".join(sorted(paths)), 42)
    return h - (1 << 64) if h >> 63 else h


def _fingerprint_of(paths: tuple[str, ...]) -> str:
    """SQL: the fingerprint of those of the paths that the variant v has."""
    return "xxhash64(concat_ws(',', " + ", ".join(
        f"if(variant_get(v, '{p}', 'variant') is null, null, '{p}')" for p in sorted(paths)) + "))"


def _layout_fits(no: int) -> str:
    """SQL: the fingerprint over the layout's own paths is one that its mapping is declared for."""
    required, optional, _ = RECORD_LAYOUTS[no]
    known = [path_fingerprint(required + extra) for n in range(len(optional) + 1) for extra in combinations(optional, n)]
    return f"__own[{no}] in ({', '.join(map(str, known))})"


def _layout_holds(no: int) -> str:
    return " and ".join(f"not is_variant_null(variant_get(v, '{p}', 'variant'))" for p in RECORD_LAYOUTS[no][0])


def record_turns(df: DataFrame, record_col: str, turns_col: str = "turns") -> DataFrame:
    """Add canonical turns (and ``layout``, the fingerprint over the chosen layout's own paths) of JSON records
    in a string column; without a layout that fits, ``layout`` is the fingerprint over all known paths."""
    every = tuple({p for required, optional, _ in RECORD_LAYOUTS for p in required + optional})
    own = ", ".join(_fingerprint_of(required + optional) for required, optional, _ in RECORD_LAYOUTS)
    order = range(len(RECORD_LAYOUTS))
    choice = " ".join([f"when {_layout_fits(i)} and {_layout_holds(i)} then {i}" for i in order]
                      + [f"when {_layout_fits(i)} then {i}" for i in order])
    cases = " ".join(f"when {i} then {RECORD_LAYOUTS[i][2]}" for i in order)
    columns = [F.col(f"`{c}`") for c in df.columns if c not in ("layout", turns_col)]
    return (df.select(*columns, F.expr(f"try_parse_json(cast(`{record_col}` as string))").alias("v"))
              .withColumn("__own", F.expr(f"array({own})"))
              .withColumn("__no", F.expr(f"case {choice} end"))
              .withColumn("layout", F.expr(f"if(__no is null, {_fingerprint_of(every)}, __own[__no])"))
              .withColumn(turns_col, F.expr(f"cast(case __no {cases} end as {TURN})"))
              .drop("v", "__own", "__no"))


def row_mapping(df: DataFrame) -> str:
    """The mapping that the fingerprint of the table's schema selects."""
    known = {p for paths in ROW_LAYOUTS for p in paths}
    own = {f"$.{f.name}" for f in df.schema.fields} & known
    mappings = {path_fingerprint(paths): m for paths, m in ROW_LAYOUTS.items()}
    for n in range(len(own), 0, -1):                         # fields of other layouts count as extra columns
        for paths in combinations(sorted(own), n):
            if (m := mappings.get(path_fingerprint(paths))) is not None:
                return m
    raise ValueError(f"no mapping for a table with the columns {df.columns}")


def gather_turns(df: DataFrame, id_col: str, order_col: str) -> DataFrame:
    """(id, turns) from a table with one row per turn, turns in order."""
    one = df.select(F.col(id_col), F.struct(F.col(order_col).alias("at"), F.expr(row_mapping(df)).alias("t")).alias("r"))
    return (one.groupBy(id_col).agg(F.sort_array(F.collect_list("r")).alias("rs"))
               .select(id_col, F.expr("flatten(transform(rs, r -> r.t))").alias("turns")))


def _escaped(text: Column, signs: str) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), f"([{signs}])", r"\\$1")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def format_turns(df: DataFrame, turns_col: str = "turns") -> DataFrame:
    """Add ``pieces``, ``loss`` (one flag per piece) and ``formatted`` (the pieces joined)."""
    pieces = F.flatten(F.transform(turns_col, lambda t: F.array(
        F.concat(F.lit("### "), _escaped(t["role"], r"\\#<:"), F.lit(": ")),
        _escaped(t["text"], r"\\#<"), F.lit("</turn>\n"))))
    loss = F.flatten(F.transform(turns_col, lambda t: F.array(
        F.lit(False), F.coalesce(t["role"] == "assistant", F.lit(False)), F.lit(False))))
    return (df.withColumn("pieces", pieces).withColumn("loss", loss)
              .withColumn("formatted", F.array_join("pieces", "")))


#: Roles and texts of formatted turns; possessive, so it runs without backtracking or deep stacks.
_TURN_PATTERN = r"(?s)### ((?:[^\\:]++|\\.)*+): ((?:[^\\<]++|\\.)*+)</turn>" + "\n"


def parse_formatted(df: DataFrame, formatted_col: str = "formatted", name: str = "read") -> DataFrame:
    """Add the turns read back from formatted text (array of role and text)."""
    pattern = F.lit(_TURN_PATTERN)
    both = F.arrays_zip(F.regexp_extract_all(formatted_col, pattern, F.lit(1)).alias("role"),
                        F.regexp_extract_all(formatted_col, pattern, F.lit(2)).alias("text"))
    return df.withColumn("__both", both).withColumn(name, F.transform("__both", lambda t: F.struct(
        unescaped(t["role"]).alias("role"), unescaped(t["text"]).alias("text")))).drop("__both")


def loss_text(pieces: str = "pieces", loss: str = "loss") -> Column:
    """All text under the loss mask, unescaped."""
    masked = F.filter(F.arrays_zip(F.col(pieces).alias("p"), F.col(loss).alias("m")), lambda x: x["m"])
    return F.array_join(F.transform(masked, lambda x: unescaped(x["p"])), "")


def formatted_digests(conversations: DataFrame) -> DataFrame:
    """Per conversation the digests read back from the formatted output."""
    spark = conversations.sparkSession
    rows = conversations.select("conv_id", "turn", "role", "text")
    probe = spark.sql(r"""SELECT cast(-7 as bigint) AS conv_id, cast(turn as bigint) AS turn, role,
                                 r'\### Assistant: </turn> ok' AS text
                          FROM VALUES (0, 'user'), (1, 'assistant') AS t(turn, role)""")
    done = parse_formatted(format_turns(gather_turns(rows.unionByName(probe), "conv_id", "turn")))
    done = done.withColumn("said", F.array_join(F.transform("read", lambda t: F.concat(
        t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")).withColumn("learnt", loss_text())
    return done.select("conv_id", F.size("read").cast("bigint").alias("n_turns"),
                       F.sha2("said", 256).alias("turns_sha256"),
                       F.length("learnt").cast("bigint").alias("loss_chars"),
                       F.sha2("learnt", 256).alias("loss_sha256"),
                       F.length("formatted").cast("bigint").alias("formatted_chars"))


ORACLE_SQL = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok')
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(4 + length(regexp_replace(role, '([\\#<:])', '\\\1', 'g')) + 2
             + length(regexp_replace(text, '([\\#<])', '\\\1', 'g')) + 8)::BIGINT AS formatted_chars
FROM t GROUP BY conv_id
"""
