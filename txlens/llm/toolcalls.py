"""Chat formatting: tool calls linked to their results, ordered, validated and serialised.

Calls and results meet in a hash join on conversation and identifier. A call comes after the
calls it names in ``after``: where every such call has a smaller turn, the turn itself is a
topological key and nothing is iterated; only conversations with a call that depends on a
later turn are ordered by peeling, one written table a level. Rows stay rows, so a very long
conversation never meets in one task.
"""

from pyspark.sql import functions as F

from txlens.staging import stage

#: Tool: argument -> (type by schema_of_variant, required).
SCHEMAS = {"reply": {"message": ("STRING", True), "words": ("BIGINT", True), "style": ("STRING", False)}}


def _problem(schemas):
    """The first fault of a call's arguments against its tool's schema; null if none."""
    tests = [F.when(F.col("name").isNull() | ~F.col("name").isin(*schemas), "unknown tool"),
             F.when(F.col("parsed").isNull(), "arguments are not JSON"),
             F.when(~F.schema_of_variant("parsed").startswith("OBJECT"), "arguments are not an object")]
    keys = F.coalesce(F.json_object_keys(F.to_json("parsed")), F.array().cast("array<string>"))
    for tool, fields in sorted(schemas.items()):
        mine = F.col("name") == tool
        for field, (kind, required) in sorted(fields.items()):
            held = F.array_contains(keys, field)
            if required:
                tests.append(F.when(mine & ~held, f"{field} is missing"))
            value = F.try_variant_get("parsed", f"$['{field}']", "variant")
            tests.append(F.when(mine & held & (F.schema_of_variant(value) != kind), f"{field} is not {kind}"))
        known = F.array(*[F.lit(f) for f in sorted(fields)]) if fields else F.array().cast("array<string>")
        tests.append(F.when(mine & (F.size(F.array_except(keys, known)) > 0), "unknown argument"))
    return F.coalesce(*tests)


def _levels(calls, edges):
    """``conv_id, call_id, step`` of calls by peeling; calls on or behind a cycle are missing."""
    left, ties, level, done = stage(calls.select("conv_id", "call_id")), stage(edges), 0, None
    while True:
        blocked = ties.select("conv_id", F.col("later").alias("call_id")).distinct()
        ready = stage(left.join(blocked, ["conv_id", "call_id"], "left_anti"))
        if ready.isEmpty():
            return done
        step = ready.withColumn("step", F.lit(level).cast("long"))
        done = step if done is None else done.unionByName(step)
        left = stage(left.join(ready, ["conv_id", "call_id"], "left_anti"))
        gone = ready.withColumnRenamed("call_id", "earlier")
        ties = stage(ties.join(gone, ["conv_id", "earlier"], "left_anti"))
        level += 1


def _others(all_calls, calls, all_results, results, stepped, schema):
    """Calls and results beside the first of their identifier, and those without an identifier."""
    key = ["conv_id", "call_id"]
    nameless = F.col("conv_id").isNull() | F.col("call_id").isNull()
    none, zero = F.lit(None), F.lit(0).cast("long")
    first = stepped.select(*key, F.struct("turn", "name", "arguments", "after").alias("_first"), "step", "n_calls")
    again = stage(calls.where("n_calls > 1").select(*key))
    calls_again = (all_calls.join(again, key).join(first, key).where(~F.col("c").eqNullSafe(F.col("_first")))
                   .groupBy(*key, "c", "step", "n_calls").agg(F.count("*").alias("_equal")).join(results, key, "left")
                   .select(*key, "c.*", "step", "n_calls", F.col("r.output").alias("output"), F.coalesce("n_results", zero).alias("n_results"),
                           F.lit(False).alias("further")))
    nameless_calls = all_calls.where(nameless).select(
        *key, "c.*", F.col("c.turn").cast("long").alias("step"), F.lit(1).cast("long").alias("n_calls"),
        none.cast("string").alias("output"), zero.alias("n_results"), F.lit(False).alias("further"))
    more = stage(results.where("n_results > 1").select(*key, F.col("r").alias("_first"), "n_results"))
    results_again = (all_results.join(more, key).where(~F.col("r").eqNullSafe(F.col("_first")))
                     .groupBy(*key, "r", "n_results").agg(F.count("*").alias("_equal"))
                     .select(*key, "r", "n_results", F.lit(True).alias("further")))
    nameless_results = all_results.where(nameless).select(*key, "r", F.lit(1).cast("long").alias("n_results"), F.lit(False).alias("further"))
    later = results_again.unionByName(nameless_results).select(
        *key, F.col("r.result_turn").alias("turn"), none.cast("string").alias("name"), none.cast("string").alias("arguments"),
        none.cast("array<string>").alias("after"), none.cast("long").alias("step"), zero.alias("n_calls"),
        F.col("r.output").alias("output"), "n_results", "further")
    return calls_again.unionByName(nameless_calls).unionByName(later).select(
        *[F.col(field.name).cast(field.dataType).alias(field.name) for field in schema])


def link_calls(calls, results, schemas=None):
    """One row per call of a conversation, one per result without a call, one per further result.

    ``calls``: conv_id, turn, call_id, name, arguments (JSON text), after (array of call_ids).
    ``results``: conv_id, turn, call_id, output. Returns conv_id, call_id, turn, step, status,
    n_calls, n_results, record. ``step`` is larger than that of every call it comes after, null on or
    behind a cycle. ``status`` is ok, no result, no call, cycle, or the fault of the arguments.
    ``record`` is canonical JSON: keys sorted, no spaces, nulls written. Of calls with one identifier the
    earliest (then that of the smaller content) gives the step; the others are validated and written as
    rows of their own, with the same step, result and ``n_calls``; equal ones are one row. Of several results the earliest is
    linked; others are rows of status "further result". Calls and results with a null identifier or
    conversation are never linked and stay a row each. Dependencies on unknown or null calls are ignored.
    """
    schemas = SCHEMAS if schemas is None else schemas
    key = ["conv_id", "call_id"]
    named = F.col("conv_id").isNotNull() & F.col("call_id").isNotNull()
    all_calls = calls.select(*key, F.struct("turn", "name", "arguments", "after").alias("c"))
    all_results = results.select(*key, F.struct(F.col("turn").alias("result_turn"), "output").alias("r"))
    calls = stage(all_calls.where(named).groupBy(*key).agg(F.min("c").alias("c"), F.count("*").alias("n_calls"))
                  .select(*key, "c.*", "n_calls"))
    results = stage(all_results.where(named).groupBy(*key).agg(F.min("r").alias("r"), F.count("*").alias("n_results")))
    edges = (calls.select("conv_id", F.col("call_id").alias("later"), F.col("turn").alias("late"),
                          F.explode("after").alias("earlier"))
             .join(calls.select("conv_id", F.col("call_id").alias("earlier"), F.col("turn").alias("early")),
                   ["conv_id", "earlier"]).distinct())
    backward = stage(edges.where("early >= late or early is null or late is null").select("conv_id").distinct())
    stepped = calls.withColumn("step", F.col("turn").cast("long"))
    if not backward.isEmpty():
        odd = calls.join(backward, "conv_id", "left_semi")
        levels = _levels(odd, edges.join(backward, "conv_id", "left_semi").select("conv_id", "earlier", "later"))
        fine = calls.join(backward, calls["conv_id"].eqNullSafe(backward["conv_id"]), "left_anti")
        odd = odd.withColumn("step", F.lit(None).cast("long")) if levels is None else odd.join(levels, key, "left")
        stepped = fine.withColumn("step", F.col("turn").cast("long")).unionByName(odd)
    linked = stepped.join(results, key, "full").select(
        *key, F.coalesce("turn", "r.result_turn").cast("long").alias("turn"), "step", "name", "arguments", "after",
        F.col("r.output").alias("output"), F.coalesce("n_calls", F.lit(0)).cast("long").alias("n_calls"),
        F.coalesce("n_results", F.lit(0)).cast("long").alias("n_results"), F.lit(False).alias("further"))
    linked = linked.unionByName(_others(all_calls, calls, all_results, results, stepped, linked.schema))
    linked = linked.withColumn("parsed", F.try_parse_json("arguments"))
    status = F.coalesce(
        F.when(F.col("further"), "further result"), F.when(F.col("n_calls") == 0, "no call"), F.when(F.col("step").isNull() & F.col("turn").isNotNull(), "cycle"),
        _problem(schemas), F.when(F.col("n_results") == 0, "no result"), F.lit("ok"))
    record = F.to_json(F.struct(
        F.array_sort("after").alias("after"), F.col("parsed").alias("arguments"), F.col("call_id").alias("id"),
        "name", "output"), {"ignoreNullFields": "false"})
    return linked.select(*key, "turn", "step", status.alias("status"), "n_calls", "n_results", record.alias("record"))


def calls_of_turns(conversations):
    """``(calls, results)`` of plain conversations: a user's turn calls ``reply``, the next turn answers.

    The call carries the message and its number of words and comes after the user's turn before.
    """
    turns = conversations.select("conv_id", "turn", "role", F.col("text").cast("string").alias("text"))
    name = F.concat(F.lit("call-"), F.col("conv_id"), F.lit("-"), F.col("turn"))
    words = F.size(F.filter(F.split("text", "[\\x20\\x09-\\x0D]+"), lambda w: w != ""))
    calls = turns.where("role = 'user'").select(
        "conv_id", "turn", name.alias("call_id"), F.lit("reply").alias("name"),
        F.to_json(F.struct(words.alias("words"), F.col("text").alias("message"))).alias("arguments"),
        F.array(F.concat(F.lit("call-"), F.col("conv_id"), F.lit("-"), F.col("turn") - 2)).alias("after"))
    results = turns.where("role = 'assistant'").select(
        "conv_id", "turn", F.concat(F.lit("call-"), F.col("conv_id"), F.lit("-"), F.col("turn") - 1).alias("call_id"),
        F.col("text").alias("output"))
    return calls, results
