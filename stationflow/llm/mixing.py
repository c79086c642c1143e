"""Mixing sources to target weights by hierarchical budgeting.

The documents form a tree of levels (domain, language, source). A node's capacity is its tokens times ``max_epochs``.
The token budget goes down the tree: siblings share their parent's budget by weight, and a sibling that cannot use its
share keeps its capacity while the shortage is shared among the others by weight (water-filling). A parent never gets
more than its subtree holds, so a shortage passes to an ancestor's siblings only when all siblings are full. Shares
are whole tokens: cumulative rounding in key order makes the children add up to the parent exactly.

A leaf with budget b over t tokens takes b div t full epochs, then the token-prefix of the next one: its documents in
the order of md5(seed:epoch:doc_id), as long as their cumulative tokens stay within the rest. Cumulative tokens come
from totals per md5 prefix; only the prefix group that holds the cut is summed row by row. Rows meet their leaf's plan
under a salt and their group's totals under the prefix, so a leaf with a third of all rows is not handled in one task.

Defined results: a null level value is the value ``(none)``; a null or empty text has no tokens and is never taken;
repeated rows are documents of their own with the same place in the order, told apart by tokens; an empty table gives
an empty result; further input columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stationflow.llm.tables import Scratch

LEVELS = ("domain", "lang", "source")
NONE = "(none)"
#: md5 hex digits that group a leaf's documents; 16**3 groups per leaf.
PREFIX = 3
#: Copies of each leaf's plan, one per salt of the rows.
SALTS = 64


def word_count(text: Column) -> Column:
    """Words between ASCII white space; null and blank texts have none."""
    return F.size(F.filter(F.split(F.coalesce(text, F.lit("")), r"[ \t-\r]+"), lambda w: w != "")).cast("bigint")


def source_domain(source: str) -> Column:
    """The default domain of a source: its trailing number modulo 4, else (none)."""
    number = F.expr(f"try_cast(regexp_extract(coalesce(`{source}`, ''), '([0-9]{{1,9}})$', 1) as bigint)")
    return F.coalesce(F.concat(F.lit("d"), (number % 4).cast("string")), F.lit(NONE))


def _weight(level: str, weights: dict[str, dict[str, int]]) -> Column:
    known = weights.get(level, {})
    out = F.lit(known.get("*", 1)).cast("bigint")
    for value, w in known.items():
        if value != "*":
            out = F.when(F.col(level) == value, F.lit(w).cast("bigint")).otherwise(out)
    return out


def leaf_budgets(leaves: DataFrame, budget: Column, levels: tuple[str, ...], weights: dict[str, dict[str, int]],
                 max_epochs: int) -> DataFrame:
    """``leaves`` (levels, tokens) with ``budget`` per leaf. One window per level over the nodes of one parent."""
    nodes = leaves.withColumn("cap", F.col("tokens") * max_epochs)
    root = nodes.agg(F.sum("cap").alias("cap"), F.sum("tokens").alias("tokens"))
    parent = root.select(F.lit(1).alias("root"), F.least(budget, F.col("cap")).alias("given"))
    above: list[str] = ["root"]
    nodes = nodes.withColumn("root", F.lit(1))
    for level in levels:
        keys = [*above, level]
        kids = nodes.groupBy(*keys).agg(F.sum("cap").alias("cap")).withColumn("w", _weight(level, weights))
        kids = kids.join(parent, above)
        up = Window.partitionBy(*above).orderBy(F.col("cap") / F.col("w"), level)
        before = F.coalesce(F.sum("cap").over(up.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        rest = F.sum("w").over(up.rowsBetween(Window.currentRow, Window.unboundedFollowing))
        kids = (kids.withColumn("left", F.col("given") - before).withColumn("rest", rest)
                .withColumn("full", F.col("cap").cast("decimal(20,0)") * F.col("rest").cast("decimal(18,0)")
                            <= F.col("w").cast("decimal(18,0)") * F.col("left").cast("decimal(20,0)")))
        # the children that are not full share what the full ones leave
        whole = Window.partitionBy(*above)
        open_ = ~F.col("full")
        kids = (kids.withColumn("pool", F.col("given")
                                - F.coalesce(F.sum(F.when(F.col("full"), F.col("cap"))).over(whole), F.lit(0)))
                .withColumn("wsum", F.sum(F.when(open_, F.col("w"))).over(whole))
                .withColumn("wcum", F.sum(F.when(open_, F.col("w")).otherwise(0)).over(
                    Window.partitionBy(*above).orderBy(level)
                    .rowsBetween(Window.unboundedPreceding, Window.currentRow))))
        share = F.expr("(cast(wcum as decimal(18,0)) * cast(pool as decimal(20,0))) div wsum"
                       " - (cast(wcum - w as decimal(18,0)) * cast(pool as decimal(20,0))) div wsum")
        kids = kids.withColumn("mine", F.when(F.col("full"), F.col("cap")).otherwise(share).cast("bigint"))
        parent = kids.select(*keys, F.col("mine").alias("given"))
        above = keys
    return leaves.join(parent.drop("root"), list(levels)).withColumnRenamed("given", "budget")


def mix(docs: DataFrame, weights: dict[str, dict[str, int]], budget_share: tuple[int, int] = (1, 2),
        max_epochs: int = 3, seed: int = 17, id_col: str = "doc_id", text_col: str = "text",
        lang_col: str = "lang", source_col: str = "source", domain: Column | None = None) -> DataFrame:
    """doc_id, domain, lang, source, n_tokens, leaf_budget, full_epochs, copies (how often the document is taken).

    ``weights``: level -> value -> integer weight, "*" for all others (default 1). ``budget_share``: the budget as a
    fraction of all tokens.
    """
    if domain is None:
        domain = source_domain(source_col)
    scratch = Scratch(docs.sparkSession, "mixing")
    rows = scratch.keep(docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"), F.coalesce(domain, F.lit(NONE)).alias("domain"),
        F.coalesce(F.col(lang_col), F.lit(NONE)).alias("lang"),
        F.coalesce(F.col(source_col), F.lit(NONE)).alias("source"),
        word_count(F.col(text_col)).alias("n_tokens")), "documents")
    leaves = rows.groupBy(*LEVELS).agg(F.sum("n_tokens").alias("tokens"))
    num, den = budget_share
    budget = F.expr(f"tokens * {num} div {den}")
    plan = leaf_budgets(leaves, budget, LEVELS, weights, max_epochs)
    plan = scratch.keep(plan.select(
        *LEVELS, F.col("budget").alias("leaf_budget"),
        F.when(F.col("tokens") > 0, F.expr("budget div tokens")).otherwise(0).cast("bigint").alias("full_epochs"),
        F.when(F.col("tokens") > 0, F.expr("budget % tokens")).otherwise(0).cast("bigint").alias("rest")), "plan")
    order = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("full_epochs").cast("string"),
                              F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"))
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("doc_id", "n_tokens"), F.lit(SALTS)).cast("int"))
    plans = plan.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    placed = scratch.keep(salted.join(plans, [*LEVELS, "salt"]).drop("salt").withColumn("h", order)
                          .withColumn("g", F.substring("h", 1, PREFIX)), "placed")
    groups = placed.groupBy(*LEVELS, "g").agg(F.sum("n_tokens").alias("t"), F.first("rest").alias("upper"))
    # tokens up to a group's end decide it: whole groups within the rest are taken, one may hold the cut
    upto = F.sum("t").over(Window.partitionBy(*LEVELS).orderBy("g"))
    groups = (groups.withColumn("upto", upto).withColumn("base", F.col("upto") - F.col("t"))
              .select(*LEVELS, "g", "base", (F.col("upto") <= F.col("upper")).alias("taken"),
                      ((F.col("base") <= F.col("upper")) & (F.col("upto") > F.col("upper"))).alias("inside")))
    marked = placed.join(groups, [*LEVELS, "g"])
    running = F.sum("n_tokens").over(Window.partitionBy(*LEVELS).orderBy("h", "doc_id", "n_tokens")
                                     .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    at_cut = (marked.where("inside").withColumn("extra", (F.col("base") + running <= F.col("rest")).cast("bigint")))
    others = marked.where("not inside").withColumn("extra", F.col("taken").cast("bigint"))
    copies = F.when(F.col("n_tokens") > 0, F.col("full_epochs") + F.col("extra")).otherwise(0).cast("bigint")
    return (at_cut.unionByName(others)
            .select("doc_id", *LEVELS, "n_tokens", "leaf_budget", "full_epochs", copies.alias("copies")))


def chosen_rows(docs: DataFrame, weights: dict[str, dict[str, int]], budget_share: tuple[int, int] = (1, 2),
                max_epochs: int = 3, seed: int = 17) -> DataFrame:
    """The rows of ``docs`` (doc_id, text, lang, source and any others) that ``mix`` takes at least once.

    Rows whose id is theirs alone are met by id. Rows without an id, and rows that share one without all being taken,
    are met by their place (id, leaf, tokens): as many of a place as were taken, in the order of a hash of the row.
    Counts per place and hash prefix decide all but one prefix of a place, so a hot place is not ranked in one task.
    """
    scratch = Scratch(docs.sparkSession, "mixture")
    leaf = ["doc_id", *LEVELS, "n_tokens"]
    chosen = scratch.keep(mix(docs, weights, budget_share, max_epochs, seed).select(
        *leaf, (F.col("copies") > 0).cast("bigint").alias("taken")), "chosen")
    ids = (chosen.where("doc_id is not null").groupBy("doc_id")
           .agg(F.count(F.lit(1)).alias("rows"), F.sum("taken").alias("taken")).where("taken > 0"))
    whole = ids.where("taken = rows").select(F.col("doc_id").alias("id"))
    part = ids.where("taken < rows").select(F.col("doc_id").alias("id"))
    out = docs.join(whole, docs["doc_id"] == whole["id"], "left_semi")
    rest = docs.where("doc_id is null").unionByName(docs.join(part, docs["doc_id"] == part["id"], "left_semi"))
    levels = [source_domain("source"), F.coalesce("lang", F.lit(NONE)), F.coalesce("source", F.lit(NONE))]
    place = F.struct(F.col("doc_id").cast("bigint").alias("doc_id"), *[c.alias(n) for n, c in zip(LEVELS, levels)],
                     word_count(F.col("text")).alias("n_tokens"))
    # the row itself is one struct, so that none of its columns can clash
    rest = scratch.keep(rest.select(place.alias("place"), F.xxhash64(*docs.columns).alias("h"),
                                    F.struct(*docs.columns).alias("row")), "rest")
    rest = rest.withColumn("g", F.shiftrightunsigned("h", 52))
    places = chosen.where("taken > 0").groupBy(F.struct(*leaf).alias("at")).agg(F.count(F.lit(1)).alias("taken"))
    groups = rest.groupBy("place", "g").agg(F.count(F.lit(1)).alias("n"))
    upto = F.sum("n").over(Window.partitionBy("place").orderBy("g"))
    groups = groups.withColumn("upto", upto).join(places, F.col("place").eqNullSafe(F.col("at"))).select(
        F.col("place").alias("p"), F.col("g").alias("pg"), "taken", "upto", (F.col("upto") - F.col("n")).alias("base"))
    rest = rest.join(groups.where("base < taken"), F.col("place").eqNullSafe(F.col("p")) & (F.col("g") == F.col("pg")))
    nth = F.row_number().over(Window.partitionBy("place", "g").orderBy("h", F.col("row.text")))
    at_cut = rest.where("upto > taken").withColumn("nth", nth).where("base + nth <= taken")
    kept = rest.where("upto <= taken").select("row.*").unionByName(at_cut.select("row.*"))
    return out.unionByName(kept)


def oracle(weights: dict[str, dict[str, int]], budget_share: tuple[int, int], max_epochs: int, seed: int) -> str:
    """The same selection as one DuckDB statement over ``documents``, level by level."""
    def weight(level: str) -> str:
        known = weights.get(level, {})
        cases = " ".join(f"WHEN '{v}' THEN {w}" for v, w in known.items() if v != "*")
        default = known.get("*", 1)
        return f"CASE {level} {cases} ELSE {default} END" if cases else str(default)

    num, den = budget_share
    sql = [f"""WITH d AS (
  SELECT doc_id,
         coalesce('d' || (TRY_CAST(nullif(regexp_extract(coalesce(source, ''), '([0-9]{{1,9}})$', 1), '') AS BIGINT) % 4),
                  '{NONE}') AS domain,
         coalesce(lang, '{NONE}') AS lang, coalesce(source, '{NONE}') AS source,
         CAST(len(list_filter(string_split_regex(coalesce(text, ''), '[ \\t-\\r]+'), lambda w: w <> '')) AS BIGINT) AS n_tokens
  FROM documents),
leaf AS (SELECT domain, lang, source, sum(n_tokens)::HUGEINT AS tokens, sum(n_tokens)::HUGEINT * {max_epochs} AS cap
         FROM d GROUP BY ALL),
g0 AS (SELECT least(sum(tokens) * {num} // {den}, sum(cap)) AS given FROM leaf)"""]
    above: list[str] = []
    for i, level in enumerate(LEVELS, 1):
        keys = [*above, level]
        part = f"PARTITION BY {', '.join(above)}" if above else ""
        join = f"JOIN g{i - 1} USING ({', '.join(above)})" if above else "CROSS JOIN g0"
        sql.append(f"""k{i} AS (
  SELECT {', '.join(keys)}, cap, w, given,
         coalesce(sum(cap) OVER ({part} ORDER BY cap::DOUBLE / w, {level} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below,
         sum(w) OVER ({part} ORDER BY cap::DOUBLE / w, {level} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest
  FROM (SELECT {', '.join(keys)}, sum(cap)::HUGEINT AS cap, {weight(level)}::HUGEINT AS w FROM leaf GROUP BY {', '.join(keys)})
  {join}),
f{i} AS (SELECT *, cap * rest <= w * (given - below) AS is_full FROM k{i}),
p{i} AS (
  SELECT *, given - coalesce(sum(CASE WHEN is_full THEN cap END) OVER ({part}), 0) AS pool,
         sum(CASE WHEN NOT is_full THEN w END) OVER ({part}) AS wsum,
         sum(CASE WHEN NOT is_full THEN w ELSE 0 END) OVER ({part} ORDER BY {level} ROWS UNBOUNDED PRECEDING) AS wcum
  FROM f{i}),
g{i} AS (
  SELECT {', '.join(keys)},
         CASE WHEN is_full THEN cap ELSE wcum * pool // wsum - (wcum - w) * pool // wsum END::HUGEINT AS given FROM p{i})""")
        above = keys
    sql.append(f"""plan AS (
  SELECT domain, lang, source, given AS leaf_budget, CASE WHEN tokens > 0 THEN given // tokens ELSE 0 END AS full_epochs,
         CASE WHEN tokens > 0 THEN given % tokens ELSE 0 END AS rest
  FROM leaf JOIN g{len(LEVELS)} USING (domain, lang, source)),
o AS (SELECT d.*, leaf_budget, full_epochs, rest,
             sum(n_tokens) OVER (PARTITION BY domain, lang, source
               ORDER BY md5('{seed}:' || full_epochs::BIGINT || ':' || coalesce(doc_id::VARCHAR, '')), doc_id, n_tokens
               ROWS UNBOUNDED PRECEDING) AS upto
      FROM d JOIN plan USING (domain, lang, source))
SELECT doc_id, domain, lang, source, n_tokens, leaf_budget::BIGINT AS leaf_budget, full_epochs::BIGINT AS full_epochs,
       CASE WHEN n_tokens > 0 THEN full_epochs + (upto <= rest)::BIGINT ELSE 0 END::BIGINT AS copies
FROM o""")
    return ",\n".join(sql[:-1]) + ",\n" + sql[-1]
