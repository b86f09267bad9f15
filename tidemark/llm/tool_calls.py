"""Linking tool calls and results in chats (operator 7, DataFrame functions only).

Calls and results are joined by conversation and identifier. Calls are ordered
topologically by the call that each comes after: their levels are found by
doubling, so a chain of n calls takes log2(n) joins. Arguments are parsed as
variants, checked against the schema of their tool, and written as canonical JSON:
keys sorted at every depth (by UTF-16 unit), no blanks, numbers in one form.

Equal numbers have one text, whatever their spelling: plain digits, without needless zeros,
if the integer digits and the decimal places are 38 at most together, else the double
nearest to it in exponent form. Numbers that no double comes near (too large, or so small
that they would become 0) are errors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import saved

# The types of a JSON schema, and how Spark names the types of parsed values.
TYPES = {
    "string": r"^STRING$", "integer": r"^(BIGINT|DECIMAL\(\d+,0\))$", "number": r"^(BIGINT|DECIMAL\(.*|DOUBLE|FLOAT)$",
    "boolean": r"^BOOLEAN$", "null": r"^VOID$", "object": r"^OBJECT<", "array": r"^ARRAY<",
}

RESULT = ["conv_id", "level", "turn", "call_id", "name", "status", "errors", "json"]


def levels(calls: DataFrame) -> DataFrame:
    """conv_id, call_id, level of distinct calls (conv_id, call_id, after); null if a call waits for itself.

    A call whose ``after`` is null or no call of the conversation is at level 0.
    """
    first = calls.select("conv_id", "call_id", "after")
    known = first.select(F.col("conv_id").alias("c"), F.col("call_id").alias("i"))
    met = first.join(known, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("after") == F.col("i")), "left")
    steps = saved(met.select("conv_id", "call_id", F.col("i").alias("up"), F.col("i").isNotNull().cast("long").alias("level")), "call-levels")
    reach, n = 1, steps.count()
    # after k rounds every chain of up to 2^k calls has met its first call; what has not by then runs in a circle
    while reach <= n and not steps.where("up is not null").isEmpty():
        above = steps.select(F.col("conv_id").alias("c"), F.col("call_id").alias("i"), F.col("up").alias("next"), F.col("level").alias("more"))
        met = steps.join(above, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("up") == F.col("i")), "left")
        steps = saved(met.select("conv_id", "call_id", F.col("next").alias("up"), (F.col("level") + F.coalesce("more", F.lit(0))).alias("level")), "call-levels")
        reach *= 2
    return steps.select("conv_id", "call_id", F.when(F.col("up").isNull(), F.col("level")).alias("level"))


def number(token: Column, outside: str) -> Column:
    """The one text of a JSON number; ``outside`` for those out of range. What is no JSON number stays as it is."""
    pattern = r"^(-?)(0|[1-9][0-9]*)(?:\.([0-9]+))?(?:[eE]([+-]?[0-9]+))?$"
    part = lambda k: F.regexp_extract(token, pattern, k)
    digits = F.concat(part(2), part(3))
    short = F.ltrim(digits, F.lit("0"))
    kept = F.rtrim(short, F.lit("0"))
    power = F.when(part(4) == "", F.lit(0).cast("bigint")).otherwise(part(4).try_cast("bigint"))
    # the value is 0.kept times ten to the power of point
    point = F.length(part(2)) - (F.length(digits) - F.length(short)) + power
    n, zeros = F.length(kept), lambda k: F.repeat(F.lit("0"), k.cast("int"))
    plain = (
        F.when(point >= n, F.concat(kept, zeros(F.least(point - n, F.lit(38)))))
        .when(point > 0, F.concat(F.substr(kept, F.lit(1), point.cast("int")), F.lit("."), F.substr(kept, point.cast("int") + 1)))
        .otherwise(F.concat(F.lit("0."), zeros(F.least(-point, F.lit(38))), kept))
    )
    fits = point.isNotNull() & (F.greatest(point, F.lit(0)) + F.greatest(n - point, F.lit(0)) <= 38)
    rest = F.substr(kept, F.lit(2))
    long = F.concat(F.substr(kept, F.lit(1), F.lit(1)), F.when(rest == "", "").otherwise(F.concat(F.lit("."), rest)), F.lit("e"), (point - 1).cast("string"))
    size = long.try_cast("double")
    inside = F.coalesce((point.between(-400, 400)) & (size > 0) & (size < float("inf")), F.lit(False))
    return (
        F.when(~token.rlike(pattern), token)
        .when(kept == "", "0")
        .when(fits, F.concat(part(1), plain))
        .when(inside, F.concat(part(1), long))
        .otherwise(outside)
    )


def with_numbers(json: Column, outside: str) -> Column:
    """A JSON text whose numbers are in one form (see ``number``), at every depth.

    Escaped quotes and backslashes are written by their numbers first, which means the
    same; then every other part between quotes lies outside of strings.
    """
    plain = F.replace(F.replace(json, F.lit("\\\\"), F.lit("\\u005c")), F.lit('\\"'), F.lit("\\u0022"))
    tokens = lambda part: F.regexp_extract_all(part, F.lit(r"-?[0-9][0-9.eE+-]*|[^0-9-]+|-"), F.lit(0))
    written = lambda part: F.array_join(F.transform(tokens(part), lambda t: number(t, outside)), "")
    return F.array_join(F.transform(F.split(plain, '"'), lambda part, k: F.when(k % 2 == 0, written(part)).otherwise(part)), '"')


def schema_errors(arguments: str, bare: str, fields: str) -> Column:
    """What is wrong with a map of variants, given the fields (field, type, required) of its tool; sorted.

    ``bare`` is the same map with null for numbers out of range, so where both differ there are some.
    """
    got, wanted = F.col(arguments), F.col(fields)
    kind = lambda f: F.schema_of_variant(got[f.field])
    fits = lambda f: F.coalesce(*[F.when(f.type == t, kind(f).rlike(pattern)) for t, pattern in TYPES.items()], F.lit(True))
    missing = F.transform(F.filter(wanted, lambda f: f.required & ~F.map_contains_key(got, f.field)), lambda f: F.concat(F.lit("missing:"), f.field))
    wrong = F.transform(F.filter(wanted, lambda f: F.map_contains_key(got, f.field) & ~fits(f)), lambda f: F.concat(F.lit("type:"), f.field))
    names = F.transform(wanted, lambda f: f.field)
    extra = F.transform(F.array_except(F.map_keys(got), names), lambda k: F.concat(F.lit("unexpected:"), k))
    text = lambda m, k: F.to_json(F.struct(m[k]))
    far = F.transform(F.filter(F.map_keys(got), lambda k: ~text(got, k).eqNullSafe(text(F.col(bare), k))), lambda k: F.concat(F.lit("range:"), k))
    return F.array_sort(F.concat(missing, wrong, far, extra))


def link_calls(calls: DataFrame, results: DataFrame, schemas: DataFrame) -> DataFrame:
    """One row per call, and per result that no call takes: ``RESULT``.

    ``calls``: conv_id, turn, call_id, name, arguments (JSON text), after (the call
    that must come first, or null). ``results``: conv_id, turn, call_id, content.
    ``schemas``: name, field, type (a key of ``TYPES``; others fit anything), required;
    a tool without fields has one row whose field is null.

    ``status`` is, the first that holds, ``no_id`` (null identifier), ``duplicate_id``
    (an earlier call has it, by turn, then name, then arguments), ``cycle``, ``invalid``
    (there are ``errors``), ``no_result`` or ``ok``; of results ``orphan_result`` or
    ``extra_result`` (the call has an earlier one, by turn, then content). Sorting by
    conv_id, level, turn and call_id gives a topological order; level is null
    for cycles, calls without identifier and results left over. Errors: malformed
    (not a JSON object), unknown_tool, missing:, type:, range: (a number in it is out of range
    and null in ``json``) and unexpected: with the field, sorted by byte,
    unknown_call (``after`` is no call), early_result (not after its call). Rows
    repeated whole get the same status. Null conversations are one like others.
    ``json`` is canonical, without keys whose value is null. More columns are not looked at.
    """
    calls = calls.select("conv_id", "turn", "call_id", "name", "arguments", "after")
    results = results.select("conv_id", "turn", "call_id", "content")
    fields = schemas.groupBy("name").agg(F.collect_set(F.when(F.col("field").isNotNull(), F.struct("field", "type", F.coalesce("required", F.lit(False)).alias("required")))).alias("fields"))

    identified = calls.where("call_id is not null")
    order = F.struct("turn", "name", "arguments", "after")
    firsts = identified.groupBy("conv_id", "call_id").agg(F.min(order).alias("first"))
    answers = results.where("call_id is not null").groupBy("conv_id", "call_id").agg(F.min(F.struct("turn", "content")).alias("answer"))
    own = levels(firsts.select("conv_id", "call_id", "first.after"))

    def by_id(left: DataFrame, right: DataFrame) -> DataFrame:
        """Left join by conversation and identifier; null conversations meet."""
        right = right.withColumnsRenamed({"conv_id": "c", "call_id": "i"})
        return left.join(right, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("call_id") == F.col("i")), "left").drop("c", "i")

    linked = by_id(by_id(by_id(calls, firsts), answers), own)
    known = firsts.select(F.col("conv_id").alias("c"), F.col("call_id").alias("i"))
    linked = linked.join(known, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("after") == F.col("i")), "left").withColumn("after_known", F.col("i").isNotNull()).drop("c", "i")
    linked = linked.join(fields, "name", "left")

    linked = linked.withColumn("variant", F.try_parse_json(with_numbers(F.col("arguments"), "null")))
    linked = linked.withColumn("whole", F.try_parse_json(with_numbers(F.col("arguments"), "0")))
    linked = linked.withColumn("bare", F.expr("try_variant_get(variant, '$', 'map<string,variant>')"))
    linked = linked.withColumn("map", F.expr("try_variant_get(whole, '$', 'map<string,variant>')"))
    single = lambda what, name: F.when(what, F.array(F.lit(name))).otherwise(F.array().cast("array<string>"))
    wrong = (
        F.when(F.col("map").isNull(), F.array(F.lit("malformed")))
        .when(F.col("fields").isNull(), F.array(F.lit("unknown_tool")))
        .otherwise(schema_errors("map", "bare", "fields"))
    )
    errors = F.concat(
        wrong,
        single(F.col("after").isNotNull() & ~F.col("after_known"), "unknown_call"),
        single(F.coalesce(F.col("answer.turn") <= F.col("turn"), F.lit(False)), "early_result"),
    )
    linked = linked.withColumn("errors", errors)
    status = (
        F.when(F.col("call_id").isNull(), "no_id")
        .when(~order.eqNullSafe(F.col("first")), "duplicate_id")
        .when(F.col("level").isNull(), "cycle")
        .when(F.size("errors") > 0, "invalid")
        .when(F.col("answer").isNull(), "no_result")
        .otherwise("ok")
    )
    linked = linked.withColumn("status", status)
    takes = ~F.col("status").isin("no_id", "duplicate_id")
    linked = linked.withColumn("level", F.when(takes, F.col("level")))
    body = F.struct(
        F.col("variant").alias("arguments"), "call_id", F.when(F.size("errors") > 0, F.col("errors")).alias("errors"), "level", "name",
        F.when(takes, F.col("answer.content")).alias("result"), "status", "turn",
    )
    done = linked.withColumn("json", F.to_json(body)).select(RESULT)

    rest = by_id(by_id(results, answers), firsts)
    taken = F.struct("turn", "content").eqNullSafe(F.col("answer"))
    rest = rest.where(F.col("first").isNull() | ~taken)
    rest = rest.withColumn("status", F.when(F.col("first").isNull(), "orphan_result").otherwise("extra_result"))
    rest = rest.withColumn("json", F.to_json(F.struct("call_id", F.col("content").alias("result"), "status", "turn")))
    rest = rest.withColumns({"level": F.lit(None).cast("long"), "name": F.lit(None).cast("string"), "errors": F.array().cast("array<string>")})
    return done.unionByName(rest.select(RESULT))


def calls_of_chats(chats: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls and results of plain chats (conv_id, turn, role, text).

    A user's turn calls tool ``reply`` and a system's turn tool ``instruct``; a
    user's call comes after that of the user's turn two turns before, if there is
    one. An assistant's turn is the result for the turn before it. Other roles are left out.
    """
    call = F.concat(F.lit("call-"), F.col("turn").cast("string"))
    said = chats.select("conv_id", "turn", "role", "text")
    before = said.where("role = 'user'").select(F.col("conv_id").alias("c"), (F.col("turn") + 2).alias("t")).distinct()
    arguments = F.to_json(F.struct(F.col("text"), F.col("turn"), F.length("text").alias("length")))
    calls = said.where("role in ('user', 'system')").join(before, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("turn") == F.col("t")), "left")
    after = F.when((F.col("role") == "user") & F.col("t").isNotNull(), F.concat(F.lit("call-"), (F.col("turn") - 2).cast("string")))
    name = F.when(F.col("role") == "user", "reply").otherwise("instruct")
    calls = calls.select("conv_id", "turn", call.alias("call_id"), name.alias("name"), arguments.alias("arguments"), after.alias("after"))
    answers = F.concat(F.lit("call-"), (F.col("turn") - 1).cast("string"))
    return calls, said.where("role = 'assistant'").select("conv_id", "turn", answers.alias("call_id"), F.col("text").alias("content"))
