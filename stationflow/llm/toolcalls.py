"""Tool-call linking: calls and results are joined by identifier, ordered, validated and written as canonical JSON.

* Link: a hash join of calls and results by call id. The earliest result (by sequence number, then text) is the
  call's result; ``n_results`` counts all. Every result without a call (no id, an unknown one, or the id of a repeated
  call) keeps a row of its own, status ``orphan``, with its own text and conversation.
* Order: a call may name the call whose result it uses (``after``). Depth is the number of calls before it on that
  chain, found by pointer doubling: each round doubles the known part, so a chain of n calls takes log2(n) rounds of
  joins on the rows still open. Within a conversation, records are ordered by (depth, sequence number, id, a hash of
  the record), which puts every call after the one it uses. A call on a cycle has depth null, status ``cycle``, and
  sorts last. A parent that does not exist, or that belongs to another conversation, counts as none and is marked
  ``dangling``.
* Validate: arguments must be a JSON object with the required fields, the declared types and nothing else.
* Serialise: the variant type keeps object keys sorted, so ``to_json(parse_json(x))`` is canonical at every depth.

Positions come from sampled splitters (``ranges``), so a conversation with a third of all rows is spread over tasks.

Defined results: a null or repeated call id is an error of that row (status ``no_id`` / ``repeated_id``; such rows
link with nothing); null arguments are invalid; null texts of results are JSON null; empty tables give an empty
result; only the named columns are read, so other columns cannot clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stationflow.llm.ranges import global_order
from stationflow.llm.tables import Scratch, empty

#: tool -> field -> (JSON type, required). The types are those of schema_of_variant.
Schemas = dict[str, dict[str, tuple[str, bool]]]

LAST = (1 << 62)
#: Copies of each repeated id of results without a call, one per salt of the rows.
SALTS = 64


def canonical(text: Column) -> Column:
    """Canonical JSON (sorted keys, no blanks), null where the text is not JSON."""
    return F.to_json(F.try_parse_json(text))


def argument_errors(arguments: Column, tool: Column, schemas: Schemas) -> Column:
    """Sorted list of what is wrong with the arguments under the tool's schema; empty if they are valid."""
    value = F.try_parse_json(arguments)
    kind = F.schema_of_variant(value)
    is_object = F.coalesce(kind.startswith("OBJECT<"), F.lit(False))
    keys = F.coalesce(F.json_object_keys(F.when(is_object, F.to_json(value))), F.expr("cast(array() as array<string>)"))
    out = F.array(F.lit("unknown tool"))
    for name, fields in schemas.items():
        found = []
        for field, (wanted, required) in sorted(fields.items()):
            got = F.schema_of_variant(F.try_variant_get(value, f"$['{field}']", "variant"))
            missing = ~F.array_contains(keys, field)
            if required:
                found.append(F.when(missing, F.lit(f"missing {field}")))
            found.append(F.when(~missing & (F.coalesce(got, F.lit("")) != wanted), F.lit(f"type of {field}")))
        extra = F.transform(F.array_except(keys, F.array(*[F.lit(f) for f in fields])),
                            lambda k: F.concat(F.lit("extra "), k))
        errors = F.array_sort(F.concat(F.array_compact(F.array(*found)), extra))
        out = F.when(tool == name, errors).otherwise(out)
    return F.when(is_object, out).otherwise(F.array(F.lit("not an object")))


def depths(nodes: DataFrame, scratch: Scratch) -> DataFrame:
    """(call_id, depth) from (call_id, parent); parent null marks a root, depth null a cycle."""
    done = nodes.where("parent is null").select("call_id", F.lit(0).cast("bigint").alias("depth"))
    live = nodes.where("parent is not null").select("call_id", F.col("parent").alias("at"), F.lit(1).cast("bigint").alias("steps"))
    # `at` is `steps` calls up; a settled ancestor gives the depth, an open one doubles the jump
    done, live = scratch.keep(done, "settled"), scratch.keep(live, "open")
    parts = [done]
    total = live.count()
    rounds = 0
    while rounds <= total.bit_length() + 1 and not empty(live):
        up = live.select(F.col("call_id").alias("at"), F.col("at").alias("at2"), F.col("steps").alias("steps2"))
        known = parts[0]
        for p in parts[1:]:
            known = known.unionByName(p)
        step = live.join(up, "at", "left").join(
            known.select(F.col("call_id").alias("at"), F.col("depth").alias("base")), "at", "left")
        step = scratch.keep(step, "step")
        settled = step.where("base is not null").select("call_id", (F.col("base") + F.col("steps")).alias("depth"))
        live = scratch.keep(step.where("base is null").select(
            "call_id", F.col("at2").alias("at"), (F.col("steps") + F.col("steps2")).alias("steps")), "open")
        parts.append(scratch.keep(settled, "settled"))
        rounds += 1
    out = live.select("call_id", F.lit(None).cast("bigint").alias("depth"))
    for p in parts:
        out = out.unionByName(p)
    return out


def link(calls: DataFrame, results: DataFrame, schemas: Schemas) -> DataFrame:
    """calls(conv_id, seq, call_id, after, tool, arguments) and results(conv_id, seq, call_id, text) as records.

    conv_id, position (0-based place in the conversation), depth, call_id, status, n_results, errors, record (JSON).
    """
    scratch = Scratch(calls.sparkSession, "toolcalls")
    c = calls.select(F.col("conv_id").cast("bigint").alias("conv_id"), F.col("seq").cast("bigint").alias("seq"),
                     "call_id", "after", "tool", "arguments")
    seen = c.where("call_id is not null").groupBy("call_id").agg(F.count(F.lit(1)).alias("uses"))
    c = scratch.keep(c.join(seen, "call_id").withColumn("bad", F.when(F.col("uses") > 1, "repeated_id")).drop("uses")
                     .unionByName(c.where("call_id is null").withColumn("bad", F.lit("no_id")))
                     .withColumn("is_call", F.lit(True)), "calls")
    r = results.select("call_id", F.col("conv_id").cast("bigint").alias("r_conv"),
                       F.col("seq").cast("bigint").alias("r_seq"), F.col("text").alias("r_text"))
    one = F.struct("r_seq", "r_text", "r_conv")
    known = (r.where("call_id is not null").groupBy("call_id")
             .agg(F.min(one).alias("first"), F.count(F.lit(1)).alias("n_results")))
    good = c.where("bad is null")
    linked = scratch.keep(good.hint("shuffle_hash").join(known, "call_id", "full_outer"), "linked")
    # the rows of an id that no good call has come one by one; salted, as one id may have a third of all results
    lost = linked.where("is_call is null")
    salt = F.pmod(F.xxhash64("r_conv", "r_seq", "r_text"), F.lit(SALTS)).cast("int")
    several = (lost.where("n_results > 1").select("call_id")
               .withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))))
    orphans = (lost.where("n_results = 1").select("call_id", "first")
               .unionByName(r.withColumn("salt", salt).join(several, ["call_id", "salt"])
                            .select("call_id", one.alias("first")))
               .unionByName(r.where("call_id is null").select("call_id", one.alias("first")))
               .withColumn("n_results", F.lit(1).cast("bigint")))
    odd = c.where("bad is not null").withColumn("first", F.lit(None).cast(known.schema["first"].dataType)) \
        .withColumn("n_results", F.lit(0).cast("bigint"))
    parents = good.select(F.col("call_id").alias("after"), F.col("conv_id").alias("p_conv"))
    nodes = scratch.keep(good.select("call_id", "conv_id", "after").join(parents, "after", "left").select(
        "call_id", F.when(F.col("p_conv").eqNullSafe(F.col("conv_id")) & F.col("p_conv").isNotNull(),
                          F.col("after")).alias("parent"), F.col("after").isNotNull().alias("named")), "nodes")
    deep = depths(nodes.select("call_id", "parent"), scratch)
    facts = deep.join(nodes, "call_id").select(
        "call_id", "depth", (F.col("named") & F.col("parent").isNull()).alias("dangling"))
    rows = (linked.where("is_call").join(facts, "call_id", "left").unionByName(odd, allowMissingColumns=True)
            .unionByName(orphans, allowMissingColumns=True))
    is_call = F.col("is_call").isNotNull()
    errors = argument_errors(F.col("arguments"), F.col("tool"), schemas)
    no_errors = F.expr("cast(array() as array<string>)")
    rows = rows.withColumn("errors", F.when(is_call, errors).otherwise(no_errors))
    status = (F.when(F.col("bad").isNotNull(), F.col("bad")).when(~is_call, "orphan")
              .when(F.col("depth").isNull(), "cycle").when(F.size("errors") > 0, "invalid")
              .when(F.col("dangling"), "dangling").when(F.coalesce(F.col("n_results"), F.lit(0)) == 0, "pending")
              .otherwise("ok"))
    rows = rows.select(
        F.coalesce(F.col("conv_id"), F.col("first.r_conv")).alias("conv_id"),
        F.coalesce(F.col("seq"), F.col("first.r_seq")).alias("seq"), "call_id", "after", "tool", "arguments", "depth",
        status.alias("status"), F.coalesce("n_results", F.lit(0)).cast("bigint").alias("n_results"), "errors",
        F.col("first.r_text").alias("result"))
    body = F.struct(F.col("after"),
                    F.coalesce(F.try_parse_json("arguments"), F.col("arguments").cast("variant")).alias("arguments"),
                    F.col("call_id").alias("id"), F.col("tool").alias("name"), F.col("result"))
    rows = rows.withColumn("record", F.to_json(body, {"ignoreNullFields": "false"}))
    key = F.struct(F.col("conv_id"), F.coalesce(F.col("depth"), F.lit(LAST)).alias("depth"), F.col("seq"),
                   F.col("call_id"), F.xxhash64("record").alias("same"))
    rows = scratch.keep(rows.select(key.alias("k"), F.lit(1).cast("bigint").alias("size"), "conv_id", "depth",
                                    "call_id", "status", "n_results", "errors", "record"), "records")
    ordered = scratch.keep(global_order(rows, scratch), "ordered")
    begins = ordered.groupBy("conv_id").agg(F.min("row_index").alias("begin")).withColumnRenamed("conv_id", "b_conv")
    return (ordered.join(begins, F.col("conv_id").eqNullSafe(F.col("b_conv")))
            .select("conv_id", (F.col("row_index") - F.col("begin")).alias("position"), "depth", "call_id", "status",
                    "n_results", F.array_join("errors", ", ").alias("errors"), "record"))


#: Tools that the query derives from conversation turns.
TURN_TOOLS: Schemas = {
    "lookup": {"key": ("STRING", True), "strict": ("BOOLEAN", False)},
    "search": {"limit": ("BIGINT", True), "query": ("STRING", True)},
}


def from_turns(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls and results read off conversation turns.

    A user turn is a call: ``search`` on even conversations, ``lookup`` on odd ones, the whole text its argument; it
    uses the call two turns earlier. Every seventh turn's limit is a string and every fifth lookup has no key, which
    the validation must find. An assistant turn is the result of the turn before it. Without a conversation or turn number
    there is no id.
    """
    conv, turn, text = F.col("conv_id"), F.col("turn"), F.col("text")
    name = F.concat(F.lit("call:"), conv.cast("string"), F.lit(":"), turn.cast("string"))
    back = F.concat(F.lit("call:"), conv.cast("string"), F.lit(":"), (turn - 2).cast("string"))
    value = F.expr("substring(to_json(named_struct('k', coalesce(text, ''))), 6)")  # "..."} of {"k":"..."}
    limit = (F.length(F.coalesce(text, F.lit(""))) % 10 + 1).cast("string")
    search = F.concat(F.lit('{"query" : '), F.expr("left({0}, length({0}) - 1)".format(
        "substring(to_json(named_struct('k', coalesce(text, ''))), 6)")),
        F.lit(', "limit" : '), F.when(turn % 7 == 6, F.lit('"10"')).otherwise(limit), F.lit("}"))
    lookup = F.when(turn % 5 == 4, F.lit('{ "strict": true }')).otherwise(
        F.concat(F.lit('{ "strict" : false , "key":'), value))
    odd = conv % 2 == 1
    calls = turns.where("role = 'user'").select(
        conv.alias("conv_id"), turn.alias("seq"), name.alias("call_id"),
        F.when(turn >= 2, back).alias("after"),
        F.when(odd, "lookup").otherwise("search").alias("tool"),
        F.when(odd, lookup).otherwise(search).alias("arguments"))
    prior = F.concat(F.lit("call:"), conv.cast("string"), F.lit(":"), (turn - 1).cast("string"))
    results = turns.where("role = 'assistant'").select(conv.alias("conv_id"), turn.alias("seq"),
                                                       prior.alias("call_id"), text.alias("text"))
    return calls, results


#: The records of ``link`` over ``from_turns`` as DuckDB SQL over ``conversations``.
ORACLE = """
WITH RECURSIVE c AS (
  SELECT conv_id, turn AS seq, 'call:' || conv_id || ':' || turn AS call_id,
         CASE WHEN turn >= 2 THEN 'call:' || conv_id || ':' || (turn - 2) END AS after,
         CASE WHEN conv_id % 2 = 1 THEN 'lookup' ELSE 'search' END AS tool, coalesce(text, '') AS text
  FROM conversations WHERE role = 'user'),
r AS (
  SELECT 'call:' || conv_id || ':' || (turn - 1) AS call_id, conv_id AS r_conv, turn AS r_seq, text AS r_text
  FROM conversations WHERE role = 'assistant'),
deep AS (
  SELECT call_id, CAST(0 AS BIGINT) AS depth FROM c WHERE after IS NULL OR after NOT IN (SELECT call_id FROM c)
  UNION ALL
  SELECT c.call_id, deep.depth + 1 FROM c JOIN deep ON c.after = deep.call_id),
j AS (
  SELECT coalesce(c.conv_id, r.r_conv) AS conv_id, coalesce(c.seq, r.r_seq) AS seq, coalesce(c.call_id, r.call_id) AS call_id,
         after, tool, text, r_text, c.call_id IS NOT NULL AS is_call, r.call_id IS NOT NULL AS has_result,
         tool = 'search' AND seq % 7 = 6 AS bad_limit, tool = 'lookup' AND seq % 5 = 4 AS no_key
  FROM c FULL JOIN r ON c.call_id = r.call_id)
SELECT conv_id,
       CAST(row_number() OVER (PARTITION BY conv_id ORDER BY coalesce(depth, 4611686018427387904), seq, call_id) - 1 AS BIGINT) AS position,
       depth, call_id,
       CASE WHEN NOT is_call THEN 'orphan' WHEN bad_limit OR no_key THEN 'invalid'
            WHEN after IS NOT NULL AND depth = 0 THEN 'dangling' WHEN NOT has_result THEN 'pending' ELSE 'ok' END AS status,
       CAST(has_result AS BIGINT) AS n_results,
       CASE WHEN is_call AND bad_limit THEN 'type of limit' WHEN is_call AND no_key THEN 'missing key' ELSE '' END AS errors,
       '{"after":' || coalesce('"' || after || '"', 'null') || ',"arguments":' ||
       CASE WHEN NOT is_call THEN 'null'
            WHEN tool = 'search' THEN '{"limit":' || CASE WHEN bad_limit THEN '"10"' ELSE CAST(length(text) % 10 + 1 AS VARCHAR) END
                 || ',"query":' || to_json(text)::VARCHAR || '}'
            WHEN no_key THEN '{"strict":true}' ELSE '{"key":' || to_json(text)::VARCHAR || ',"strict":false}' END
       || ',"id":"' || call_id || '","name":' || coalesce('"' || tool || '"', 'null')
       || ',"result":' || coalesce(to_json(r_text)::VARCHAR, 'null') || '}' AS record
FROM j LEFT JOIN deep USING (call_id)
"""
