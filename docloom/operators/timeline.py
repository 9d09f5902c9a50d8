"""Version timelines and the state machines around them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def version_timeline(deliveries: DataFrame, by: str = "resource_id", run: str = "run_seq", order: str = "seq") -> DataFrame:
    """Every delivery's outcome, reason and version number, judged against the resource's current version.

    Steps: the first delivery of a run and resource stands, later ones are replays or conflicts; failed ones
    make no version; a change of (input, parser) opens an island, whose number is the version; inside an
    island the content must equal the island's first content. One sort by (resource, run) serves all windows.
    """
    in_run = Window.partitionBy(by, run).orderBy(order)
    first = lambda c: F.first(c).over(in_run)
    same = (first("input_fp") == F.col("input_fp")) & (first("parser_fp") == F.col("parser_fp")) & (first("content_hash") == F.col("content_hash")) & first("failed_code").isNull() & F.col("failed_code").isNull()
    ranked = deliveries.withColumn("_n", F.row_number().over(in_run)).withColumn("_same", F.coalesce(same, F.lit(False)))
    along = Window.partitionBy(by).orderBy(run, order)
    good = (F.col("_n") == 1) & F.col("failed_code").isNull()
    # the previous good row's fingerprints: last non-null before this row
    before = along.rowsBetween(Window.unboundedPreceding, -1)
    prior = F.last(F.when(good, F.struct("input_fp", "parser_fp")), ignorenulls=True).over(before)
    marked = ranked.withColumn("_good", good).withColumn("_prior", prior)
    starts = F.col("_good") & (F.col("_prior").isNull() | (F.col("_prior.input_fp") != F.col("input_fp")) | (F.col("_prior.parser_fp") != F.col("parser_fp")))
    islands = marked.withColumn("_new", starts).withColumn("sequence", F.sum(F.col("_new").cast("int")).over(along.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    inside = Window.partitionBy(by, "sequence").orderBy(run, order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    base = F.first(F.when(F.col("_good"), F.col("content_hash")), ignorenulls=True).over(inside)
    judged = islands.withColumn("_base", base)
    input_moves, parser_moves = F.col("_prior.input_fp") != F.col("input_fp"), F.col("_prior.parser_fp") != F.col("parser_fp")
    reason = (
        F.when((F.col("_n") > 1) & F.col("_same"), "replayed").when((F.col("_n") > 1) & F.col("failed_code").isNotNull(), "ignored_failure").when(F.col("_n") > 1, "delivery_key_conflict")
        .when(F.col("failed_code").isNotNull(), F.col("failed_code"))
        .when(F.col("_new") & F.col("_prior").isNull(), "first_success").when(F.col("_new") & input_moves & parser_moves, "both_changed").when(F.col("_new") & input_moves, "source_changed")
        .when(F.col("_new") & (F.col("mode") == "reparse"), "parser_recomputed").when(F.col("_new"), "parser_changed")
        .when(F.col("content_hash") != F.col("_base"), "nondeterministic").otherwise("unchanged")
    )
    outcome = (
        F.when(F.col("_n") > 1, F.when(F.col("_same"), "replayed").when(F.col("failed_code").isNotNull(), "ignored").otherwise("conflict"))
        .when(F.col("failed_code").isNotNull() | (~F.col("_new") & (F.col("content_hash") != F.col("_base"))), "failed")
        .when(F.col("_new") & F.col("_prior").isNull(), "created").when(F.col("_new"), "changed").otherwise("unchanged")
    )
    return judged.select(by, run, order, outcome.alias("outcome"), reason.alias("reason"), F.when(F.col("sequence") > 0, F.col("sequence")).cast("long").alias("version"))


def document_timeline(docs: DataFrame, resource: Column, order: str) -> DataFrame:
    """J4 on raw texts: copies of a resource, in order, as versions of its normal text."""
    seen = docs.select(resource.alias("resource"), F.col(order), F.sha2(F.trim(F.regexp_replace("text", r"\s+", " ")), 256).alias("hash"))
    w = Window.partitionBy("resource").orderBy(order)
    before = F.lag("hash").over(w)
    steps = seen.withColumn("reason", F.when(before.isNull(), "created").when(before == F.col("hash"), "unchanged").otherwise("changed"))
    return steps.withColumn("version", F.sum((F.col("reason") != "unchanged").cast("long")).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))


def upsert_first(tasks: DataFrame, by: list[str], order: str) -> DataFrame:
    """The first task of every key; min of a struct combines before the shuffle."""
    rest = [c for c in tasks.columns if c not in by and c != order]
    return tasks.groupBy(*by).agg(F.min(F.struct(order, *rest)).alias("m")).select(*by, "m.*")


def register_targets(targets: DataFrame, budget: int) -> DataFrame:
    """A run's targets by first appearance of their identity; identities beyond the budget are skipped, later appearances replay."""
    in_identity = Window.partitionBy("run_id", "identity").orderBy("seq")
    firsts = targets.withColumn("_n", F.row_number().over(in_identity))
    place = firsts.where("_n = 1").withColumn("_place", F.row_number().over(Window.partitionBy("run_id").orderBy("seq"))).select("run_id", "identity", "_place")
    joined = firsts.join(place, ["run_id", "identity"])
    state = F.when(F.col("_place") > budget, "skipped").when(F.col("_n") > 1, "replay_candidate").otherwise("pending")
    return joined.select("run_id", "seq", "identity", state.alias("state"))


def registrations(targets: DataFrame, by: list[str], order: str) -> DataFrame:
    """What each appearance of a target does, and the inputs that the target then has.

    ``targets``: ``by``, ``order``, inputs (an array of keys), open (whether the target is still pending when it appears
    again). The first one registers; the same inputs are skipped; more inputs amend an open target, the new ones behind
    the old; any other appearance replays, once for each list of inputs. Appearances at one place of the order stand by
    inputs, closed ones first.

    A target's inputs only grow, and a list that has added to them, or could not when it first came to the open target,
    never adds later. So the first appearances of a target's different lists tell all its states: they alone are
    gathered and folded. Every appearance is then judged by the state at its place, and of those that would replay one
    list the first does. Appearances are only counted and joined, so that many of one target are shared among tasks.
    """
    same = reduce(lambda x, y: x & y, [F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}")) for c in by])
    place = ["_at", "inputs", "open"]
    rows = targets.select(*by, F.coalesce(F.col(order).cast("long"), F.lit(-(2**63))).alias("_at"), F.col(order).cast("long").alias("_told"), "inputs", F.coalesce("open", F.lit(False)).alias("open"))

    kind = "struct<current:array<string>,states:array<struct<_at:bigint,inputs:array<string>,open:boolean,action:string,current:array<string>>>>"

    def step(acc: Column, x: Column) -> Column:
        current, new = acc["current"], x["inputs"]
        added = F.array_except(new, current)
        more = F.concat(current, added)
        state = lambda action, held: F.array(F.struct(*[x[c].alias(c) for c in place], F.lit(action).alias("action"), held.alias("current")))
        return (
            F.when(acc.isNull(), F.struct(new.alias("current"), state("register", new).alias("states")).cast(kind))
            .when(x["open"] & (F.size(F.array_except(current, new)) == 0) & (F.size(added) > 0), F.struct(more.alias("current"), F.concat(acc["states"], state("amend", more)).alias("states")).cast(kind))
            .otherwise(acc)
        )

    firsts = rows.groupBy(*by, "inputs", "open").agg(F.min("_at").alias("_at"))
    lists = firsts.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct(*place))).alias("_lists"))
    states = lists.select(*by, F.aggregate("_lists", F.lit(None).cast(kind), step)["states"].alias("_states"))

    def judged(these: DataFrame) -> DataFrame:
        """With the state at each place, and what an appearance does that has not made this state."""
        joined = these.alias("l").join(states.alias("r"), same).select("l.*", "_states")
        here = F.struct(*place)
        state = F.element_at(F.filter("_states", lambda e: (e["_at"] < F.col("_at")) | ((e["_at"] == F.col("_at")) & (F.struct(*[e[c].alias(c) for c in place]) <= here))), -1)
        held = joined.withColumn("_state", state).drop("_states")
        current = F.col("_state.current")
        act = F.when(F.col("inputs") == current, "skip").when(F.col("open") & (F.size(F.array_except(current, F.col("inputs"))) == 0), "amend").otherwise("replay")
        return held.withColumn("_act", act).withColumn("_text", F.when(F.col("_act") == "replay", F.array_join("inputs", "\n")))

    # of each list that replays the first place
    would = judged(rows).where("_text IS NOT NULL").groupBy(*by, "_text", "inputs", "open").agg(F.min("_at").alias("_at"))
    replays = would.groupBy(*by, "_text").agg(F.min(F.struct(*place)).alias("_first"))
    equal = judged(rows.groupBy(*by, "_told", *place).agg(F.count(F.lit(1)).alias("_n")))
    all_ = equal.alias("l").join(replays.alias("r"), same & (F.col("l._text") == F.col("r._text")), "left").select("l.*", "_first")
    is_at = lambda c: F.coalesce(reduce(lambda x, y: x & y, [F.col(f"{c}.{p}").eqNullSafe(F.col(p)) for p in place]), F.lit(False))
    made, again = is_at("_state"), F.col("_text").isNotNull()
    first = F.when(made, F.col("_state.action")).when(again & ~is_at("_first"), "skip").otherwise(F.col("_act"))
    rest = F.when(again, "skip").otherwise(F.col("_act"))
    told = all_.withColumn("action", F.explode(F.concat(F.array(first), F.array_repeat(rest, (F.col("_n") - 1).cast("int")))))
    return told.select(*by, F.col("_told").alias(order), "action", F.when(F.col("action") == "replay", F.col("inputs")).otherwise(F.col("_state.current")).alias("inputs"))


def valid_volumes(rows: DataFrame, key: str) -> DataFrame:
    """Whether a document's volumes are numbered 1..n, without a primary beside, and at most one primary."""
    volume, primary = F.col("role") == "volume", F.col("role") == "primary"
    agg = rows.groupBy(key).agg(F.count_if(volume).alias("n"), F.count_if(primary).alias("primaries"), F.count_if(volume & F.col("volume_order").isNull()).alias("unnumbered"), F.array_sort(F.collect_list(F.when(volume, F.col("volume_order")))).alias("orders"))
    ordered = F.when(F.col("n") == 0, True).otherwise(F.col("orders") == F.sequence(F.lit(1), F.greatest(F.col("n"), F.lit(1)).cast("int")))
    error = F.when((F.col("unnumbered") > 0) | ~ordered, "volume_order_ambiguous").when((F.col("n") > 0) & (F.col("primaries") > 0), "volume_and_primary_conflict").when(F.col("primaries") > 1, "multiple_primary_deliverables")
    return agg.select(key, error.alias("error"))


def assign_attachments(files: DataFrame, key: str) -> DataFrame:
    """Numbered files are volumes if there are two; a number that comes twice voids all numbers; the rest follows."""
    w = Window.partitionBy(key)
    numbered = F.count("number").over(w)
    counted = files.withColumn("_numbered", numbered).withColumn("_same", F.when(F.col("number").isNotNull(), F.count(F.lit(1)).over(Window.partitionBy(key, "number"))))
    counted = counted.withColumn("_void", F.max("_same").over(w) > 1)
    is_volume = (F.col("_numbered") >= 2) & F.col("number").isNotNull()
    place = F.row_number().over(Window.partitionBy(key, is_volume).orderBy("position"))
    role = F.when(is_volume, "volume").when((F.col("_numbered") < 2) & (place == 1), "primary").otherwise("independent_attachment")
    return counted.select(key, "position", role.alias("role"), F.when(is_volume & ~F.col("_void"), F.col("number")).alias("volume_order"))


def within_budget(requests: DataFrame, by: str, order: str, costs: dict[str, float]) -> DataFrame:
    """Running sums of each cost; a request is allowed while none is over its budget."""
    w = Window.partitionBy(by).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ok = F.lit(True)
    for column, most in costs.items():
        ok = ok & (F.sum(F.col(column) if column != "1" else F.lit(1)).over(w) <= most)
    return requests.withColumn("allowed", ok)


def eligibility(run: DataFrame, source: DataFrame) -> DataFrame:
    """The first reason for which a run may not go on; null: it may."""
    s = source.select(F.col("id").alias("source_id"), F.col("generation").alias("_generation"), "paused", "write_seq")
    error = (
        F.when(F.col("attempt_epoch") >= F.col("max_attempts"), "attempts_exhausted").when(F.col("generation") != F.col("_generation"), "source_generation_changed")
        .when(F.col("paused"), "source_paused").when(F.col("write_seq") > F.col("run_seq"), "run_superseded")
    )
    return run.join(s, "source_id").select("id", error.alias("error"))


def terminal_status(reason: Column, exhausted: Column) -> Column:
    """What a broken attempt leaves: retryable only for a dead child or an interruption, while attempts are left."""
    return F.when(reason == "interrupted", "retryable").when(exhausted | ~reason.isin("child_process_failed", "interrupted"), "failed").otherwise("retryable")


def fetch_route(state: Column, outcome: Column, error: Column) -> Column:
    """The state of a request task after its fetch."""
    stopping = ["inactive_attempt", "run_not_started", "request_budget_exceeded", "crawl_time_budget_exceeded", "deadline_exceeded"]
    return F.when((state == "archived") & (outcome == "ok"), "archived").when((state == "cancelled") | (error == "interrupted"), "interrupted").when(error.isin(stopping), "truncated").otherwise("failed")


def first_failed_input(targets: DataFrame, inputs: DataFrame, requests: DataFrame) -> DataFrame:
    """A target's error is that of its first failed input by position."""
    bad = inputs.join(requests.select(F.col("id").alias("request_id"), "error").where("error IS NOT NULL"), "request_id")
    first = bad.groupBy("target_id").agg(F.min(F.struct("position", "error")).alias("m"))
    return targets.join(first.withColumnRenamed("target_id", "id"), "id", "left").select("id", F.concat(F.lit("required_input_failed:"), F.col("m.error")).alias("error"))
