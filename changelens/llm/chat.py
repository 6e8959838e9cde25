"""Chat formatting by schema fingerprints.

Records come as JSON in any of several layouts.  The nested field paths of a
record (names and nesting, without types) are hashed; the hash selects a
declarative mapping, one per known layout, that turns the record into canonical
turns (role, text).  Turns are then laid out with a template that marks turns
and escapes control strings, with the byte spans that the loss covers.

Template: ``<s>``, then for each turn ``<|turn|>ROLE\\nTEXT<|end|>\\n``.  In
ROLE and TEXT ``&`` becomes ``&0;``, ``<`` ``&1;`` and ``[`` ``&2;`` (in ROLE
also a line break ``&3;``), so neither a marker of this template nor one of
another (``</s>``, ``[INST]``) can occur in them, and undoing it in the
opposite order gives the text back.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import product

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from changelens.llm.common import let, table

BEGIN, TURN, END = "<s>", "<|turn|>", "<|end|>\n"
ESCAPES = (("&", "&0;"), ("<", "&1;"), ("[", "&2;"))
ROLE_ESCAPES = (*ESCAPES, ("\n", "&3;"))
PROBE = "</s>[INST] ok [/INST]"
#: Strings that Spark's JSON parser takes are no longer than this.
PARSED_CHARS = 20_000_000
#: Strings of a message that go through its JSON record have no more bytes than this: with all escapes the record stays within the parser's bounds.
CARRIED_BYTES = 1_000_000
#: Other layouts' names of the roles.
ROLES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant", "ai": "assistant"}


@dataclass(frozen=True)
class Layout:
    """One layout: either a list of turns at ``items`` with fields ``role`` and
    ``text``, or fixed (role, field) pairs; fields joined by ``+`` make one turn."""

    name: str
    fields: tuple[tuple[str, str], ...] = ()
    items: str = ""
    role: str = "role"
    text: str = "text"
    optional: tuple[str, ...] = ()
    roles: bool = True  # whether other names of the roles are put into the canonical ones

    def paths(self) -> list[tuple[str, ...]]:
        """Every set of field paths of this layout, with and without its optional fields."""
        if self.items:
            full = [f"{self.items}[]", *(f"{self.items}[].{f}" for f in (self.role, self.text))]
            return [(f"{self.items}[]",), *self._with(full)]
        return self._with([x for _, f in self.fields for x in f.split("+") if x not in self.optional])

    def _with(self, needed: list[str]) -> list[tuple[str, ...]]:
        return [tuple(sorted(needed + [o for o, on in zip(self.optional, picks, strict=True) if on]))
                for picks in product((False, True), repeat=len(self.optional))]

    def turns(self) -> str:
        """SQL for the array of (role, text) of the variant ``v``."""
        if self.items:
            got = f"try_variant_get(v, '$.{self.items}', 'array<struct<`{self.role}` string, `{self.text}` string>>')"
            return f"transform({got}, x -> struct(x.`{self.role}` as role, x.`{self.text}` as text))"
        one = []
        for role, fields in self.fields:
            parts = [f"try_variant_get(v, '$.{f}', 'string')" for f in fields.split("+")]
            given = " AND ".join(f"{p} IS NULL" for p in parts)
            joined = f"array_join(filter(array({', '.join(parts)}), x -> x <> ''), '\n\n')"
            one.append(f"if({given}, null, struct('{role}' as role, {joined} as text))")
        return f"filter(array({', '.join(one)}), x -> x is not null)"


LAYOUTS = (
    Layout("turn", (), "turns", "role", "text", ("turns[].turn",), False),
    Layout("messages", (), "messages", "role", "content", ("system",)),
    Layout("conversations", (), "conversations", "from", "value", ("system",)),
    Layout("instruction", (("system", "system"), ("user", "instruction+input"), ("assistant", "output")), optional=("system", "input")),
    Layout("prompt", (("system", "system"), ("user", "prompt"), ("assistant", "response")), optional=("system",)),
    Layout("completion", (("system", "system"), ("user", "prompt"), ("assistant", "completion")), optional=("system",)),
    Layout("question", (("system", "system"), ("user", "question"), ("assistant", "answer")), optional=("system",)),
)
#: Fields that tell layouts apart, at the top and in lists; any others (ids, scores, dates) don't count.
TELLING = sorted({x.split("[")[0] for layout in LAYOUTS for p in layout.paths() for x in p})
NESTED = sorted({x for layout in LAYOUTS for p in layout.paths() for x in p if "." in x})


def _paths(v: Column) -> Column:
    """Sorted paths of the telling fields of a variant object: ``a``, ``a[]``, ``a[].b``."""
    out = []
    for name in TELLING:
        whole = F.expr(f"schema_of_variant(try_variant_get(v, '$.{name}', 'variant'))")
        inner = F.regexp_extract(whole, r"^ARRAY<OBJECT<(.*)>>$", 1)
        # names directly inside: drop the content of deeper brackets, then the types
        flat = F.regexp_replace(F.regexp_replace(inner, r"<[^<>]*(?:<[^<>]*(?:<[^<>]*>[^<>]*)*>[^<>]*)*>", ""), r"\([^)]*\)", "")
        telling = [x for x in NESTED if x.startswith(f"{name}[].")]
        names = F.when(inner == "", F.array().cast("array<string>")).otherwise(F.filter(
            F.transform(F.split(flat, ", "), lambda x: F.concat(F.lit(f"{name}[]."), F.regexp_replace(x, ": [A-Z ]+$", ""))),
            lambda x: x.isin(telling)))
        out.append(F.when(whole.isNull(), F.array().cast("array<string>"))
                   .when(whole.startswith("ARRAY<"), F.concat(F.array(F.lit(f"{name}[]")), names))
                   .otherwise(F.array(F.lit(name))))
    return F.array_sort(F.array_distinct(F.flatten(F.array(*out))))


def fingerprint(paths: Column) -> Column:
    return F.xxhash64(F.array_join(paths, "|"))


def canonical(records: DataFrame, record: str = "record") -> DataFrame:
    """``records`` with ``layout`` and ``turns`` (array of role, text) for its JSON column.

    Defined cases: JSON that is null or broken, and layouts without a mapping,
    have layout ``unknown`` and no turns; fields that tell no layout apart are
    ignored; a null role or text in a turn is empty; roles get their canonical
    names in lower case, but in layouts with canonical roles of their own.
    A record of over ``PARSED_CHARS`` characters that does not parse raises: it
    may be whole and only too long for the parser.
    """
    parsed = records.withColumn("v", F.expr(f"try_parse_json(`{record}`)"))
    seen = parsed.withColumn("_print", fingerprint(_paths(F.col("v"))))
    known = records.sparkSession.range(1).select(F.explode(F.array(*[
        F.struct(F.lit(layout.name).alias("layout"), fingerprint(F.array(*[F.lit(x) for x in p])).alias("_key"))
        for layout in LAYOUTS for p in layout.paths()])).alias("k")).select("k.*")
    named = seen.join(F.broadcast(known), seen["_print"] == known["_key"], "left")
    turns = F.array().cast("array<struct<role:string,text:string>>")
    for layout in LAYOUTS:
        turns = F.when(F.col("layout") == layout.name, F.expr(layout.turns())).otherwise(turns)
    own = F.col("layout").isin([layout.name for layout in LAYOUTS if not layout.roles])
    usual = F.create_map(*[F.lit(x) for kv in ROLES.items() for x in kv])
    role = lambda r: F.coalesce(F.when(own, r).otherwise(F.coalesce(usual[F.lower(r)], F.lower(r))), F.lit(""))
    tidy = F.transform(
        F.coalesce(turns, F.array().cast("array<struct<role:string,text:string>>")),
        lambda t: F.struct(role(t["role"]).alias("role"), F.coalesce(t["text"], F.lit("")).alias("text")))
    return named.withColumn("turns", tidy).withColumn("layout", F.coalesce("layout", F.when(
        F.col("v").isNull() & (F.length(record) > PARSED_CHARS), F.raise_error(F.lit("a record is too long to be parsed as JSON")).cast("string"))
        .otherwise(F.lit("unknown")))).drop("v", "_print", "_key")


def escaped(c: Column, escapes: tuple[tuple[str, str], ...] = ESCAPES) -> Column:
    for raw, safe in escapes:
        c = F.replace(c, F.lit(raw), F.lit(safe))
    return c


def unescaped(c: Column, escapes: tuple[tuple[str, str], ...] = ESCAPES) -> Column:
    for raw, safe in reversed(escapes):
        c = F.replace(c, F.lit(safe), F.lit(raw))
    return c


def formatted(turns: DataFrame) -> DataFrame:
    """(conv_id, formatted, loss_spans) from rows (conv_id, place, role, text).

    ``loss_spans``: start and length in UTF-8 bytes of each assistant text.
    Offsets are a running sum over a conversation's turns.  A conversation's
    turns must meet to make one string; nothing larger does.
    """
    head = F.concat(F.lit(TURN), escaped(F.col("role"), ROLE_ESCAPES), F.lit("\n"))
    body = escaped(F.col("text"))
    w = Window.partitionBy("conv_id").orderBy("place", "role", "text").rowsBetween(Window.unboundedPreceding, -1)
    laid = turns.select("conv_id", "place", "role", "text", head.alias("head"), body.alias("body")).withColumn(
        "start", F.coalesce(F.sum(F.octet_length("head") + F.octet_length("body") + len(END)).over(w), F.lit(0)) + len(BEGIN))
    span = F.when(F.col("role") == "assistant", F.struct(
        (F.col("start") + F.octet_length("head")).alias("start"), F.octet_length("body").cast("long").alias("length")))
    rows = laid.groupBy("conv_id").agg(F.array_sort(F.collect_list(
        F.struct("start", F.concat("head", "body", F.lit(END)).alias("piece"), span.alias("span")))).alias("rows"))
    return rows.select(
        "conv_id", F.concat(F.lit(BEGIN), F.array_join(F.col("rows.piece"), "")).alias("formatted"),
        F.filter(F.col("rows.span"), lambda s: s.isNotNull()).alias("loss_spans"))


def read_turns(text: Column) -> Column:
    """The turns (role, text) of a formatted conversation."""
    pieces = F.split(F.substr(text, F.lit(len(BEGIN) + 1)), r"<\|end\|>\n")
    given = F.filter(pieces, lambda p: p != "")

    def turn(p: Column) -> Column:
        role = F.substring_index(F.substr(p, F.lit(len(TURN) + 1)), "\n", 1)
        return F.struct(
            unescaped(role, ROLE_ESCAPES).alias("role"),
            unescaped(F.substr(p, F.length(role) + len(TURN) + 2)).alias("text"))

    return F.transform(given, turn)


def read_loss(text: Column, spans: Column) -> Column:
    """The texts under the loss mask, in order."""
    return let(text.cast("binary"), lambda raw: F.transform(spans, lambda s: unescaped(F.decode(
        F.substr(raw, (s["start"] + 1).cast("int"), s["length"].cast("int")), "utf-8"))))


def _carried(c: str) -> Column:
    """A string goes through JSON unless it is longer than a parsed record may be, or no valid UTF-8; null does."""
    return F.coalesce((F.octet_length(c) <= CARRIED_BYTES) & F.is_valid_utf8(c), F.lit(True))


def format_conversations(rows: DataFrame) -> DataFrame:
    """(conv_id, formatted, loss_spans) from message rows (conv_id, turn, role, text).

    Every row is a record of layout ``turn``, and its role and text are those
    that the mapping takes out of the record.  A string that the JSON parser
    may refuse (``_carried``) is left out of the record, which holds an empty
    one in its place, and comes from its column.  Defined cases: null text is empty, null role is
    empty; turns are in order of ``turn`` (null first), ties by role and text;
    rows that repeat are turns of their own; a null conv_id is a conversation.
    """
    inside = lambda c: F.when(_carried(c), F.col(c)).otherwise(F.lit("")).alias(c)
    shape = F.array(F.struct(inside("role"), inside("text"), F.col("place").alias("turn")))
    records = rows.select("conv_id", F.col("turn").cast("long").alias("place"), "role", "text").withColumn(
        "record", F.to_json(F.struct(shape.alias("turns")), {"ignoreNullFields": "false"}))
    named = canonical(records)
    mapped = F.when(F.size("turns") == 1, F.element_at("turns", 1)).otherwise(
        F.raise_error(F.concat(F.lit("not one turn from a record of layout "), F.col("layout"))))
    turns = named.withColumn("turn", mapped).select(
        "conv_id", "place", *[F.when(_carried(c), F.col(f"turn.{c}")).otherwise(F.col(c)).alias(c) for c in ("role", "text")])
    return formatted(turns)


def digests(done: DataFrame) -> DataFrame:
    """What is read back from formatted conversations."""
    back = done.select(
        "conv_id", F.length("formatted").cast("long").alias("formatted_chars"),
        read_turns(F.col("formatted")).alias("turns"),
        F.array_join(read_loss(F.col("formatted"), F.col("loss_spans")), "").alias("loss"))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.col("role").cast("string"), F.col("text").cast("string"))
    probe = spark.range(1).select(F.explode(F.array(
        F.struct(F.lit(0).alias("turn"), F.lit("user").alias("role")),
        F.struct(F.lit(1).alias("turn"), F.lit("assistant").alias("role")))).alias("t")).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("t.turn").cast("long").alias("turn"), "t.role", F.lit(PROBE).alias("text"))
    return digests(format_conversations(rows.unionByName(probe)))


SQL = """
WITH r AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')),
g AS (
  SELECT conv_id, count(*) AS n_turns,
    string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS said,
    coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '') AS loss,
    3 + sum(8 + length(role) + 2 * length(regexp_replace(role, '[^&<[' || chr(10) || ']', '', 'g')) + 1
            + length(text) + 2 * length(regexp_replace(text, '[^&<[]', '', 'g')) + 8) AS formatted_chars
  FROM r GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(said) AS turns_sha256, CAST(length(loss) AS BIGINT) AS loss_chars, sha256(loss) AS loss_sha256,
       CAST(formatted_chars AS BIGINT) AS formatted_chars FROM g
"""
