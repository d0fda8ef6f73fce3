"""The pN_ queries: each runs its problem's operator over its whole tables with production parameters."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from lexmill.functions.rows import read
from lexmill.llm import cutoffs, language, leakage, mixing, packing, personal, repetition, splitting, token_budget


def _mix(spark, d):
    return mixing.mix(read(spark, d, "scored_docs"), read(spark, d, "mix_targets"))


def p1_found(spark, d):
    return _mix(spark, d)[1].where("not reachable").select(F.col("spelling").alias("subset")).distinct()


def p1_mix(spark, d):
    return _mix(spark, d)[0]


def p1_shares(spark, d):
    return _mix(spark, d)[1]


def p1_sizes(spark, d):
    """Per subset with a target: its words, and what its mix must hold: max_repeats times its words where it cannot reach the target, else
    the target within one row; no row is used more than max_repeats times."""
    mixed, report = _mix(spark, d)
    used = mixed.groupBy("subset").agg(F.max("copies").alias("most"))
    longest = mixing.sizes(read(spark, d, "scored_docs")).groupBy("subset").agg(F.max("words").alias("longest"))
    r = report.where("spelling is not null").join(used, "subset", "left").join(longest, "subset", "left")
    near = F.abs(F.col("mixed_words") - F.col("target_words")) <= F.coalesce("longest", F.lit(0)) + 1
    return r.select(F.col("spelling").alias("subset"), "words", "reachable", F.when(~F.col("reachable"), F.col("mixed_words")).alias("all_words"), (near | ~F.col("reachable")).alias("near"), (F.coalesce("most", F.lit(0)) <= F.col("max_repeats")).alias("within"))


def _repetition(spark, d):
    return repetition.repetition(read(spark, d, "rewrite_output"), read(spark, d, "generate_output"))


def p2_found(spark, d):
    return _repetition(spark, d).where(F.col("share") >= repetition.SHARE).select("record_table", "row_id").distinct()


def p2_repetition(spark, d):
    return _repetition(spark, d)


def p2_kept(spark, d):
    """Records within both limits: the share of repeated words and the longest single repeat."""
    return repetition.keep(_repetition(spark, d)).select("record_table", "row_id").distinct()


def p3_token_budget(spark, d):
    return token_budget.token_budget(read(spark, d, "scored_docs"), read(spark, d, "token_pieces"))


def p3_row_tokens(spark, d):
    from lexmill.llm.pieces import load

    return token_budget.row_tokens(read(spark, d, "scored_docs"), load(read(spark, d, "token_pieces"))).select("row_id", "n_tokens")


def _cut(spark, d):
    return cutoffs.cutoffs(read(spark, d, "mds_input"), read(spark, d, "keep_slices"))


def p4_found(spark, d):
    return _cut(spark, d)[1].select("slice_id", "row_id").distinct()


def p4_cutoffs(spark, d):
    return _cut(spark, d)[0]


def p5_found(spark, d):
    got = splitting.split(read(spark, d, "split_input"), with_text=False)
    kinds = F.array_compact(F.array(F.when(F.col("piece") == 1, "oversized"), F.when((F.col("piece") == 1) & (F.col("longest_run") > splitting.LIMIT), "unbroken")))
    return got.where("piece = 1").select("row_id", F.explode(kinds).alias("kind")).distinct()


def p5_pieces(spark, d):
    return splitting.split(read(spark, d, "split_input"))


def p5_tiling(spark, d):
    """Per delivered text its characters, counted over the pieces without their overlaps, the pieces over the limit, and the overlaps that
    are too long or not the end of the piece before."""
    got = splitting.split(read(spark, d, "split_input").where("text is not null").select("row_id", "text").distinct())
    before = F.lag("text").over(Window.partitionBy("row_id").orderBy("piece"))  # one text
    got = got.withColumn("lead", F.substr("text", F.lit(1), F.col("overlap"))).withColumn("before", before)
    wrong = (F.col("overlap") > splitting.OVERLAP) | ((F.col("overlap") > 0) & ~F.col("before").endswith(F.col("lead")))
    return got.groupBy("row_id").agg(F.sum(F.col("end_pos") - F.col("start_pos") - F.col("overlap")).alias("n_chars"), F.count_if(F.length("text") > splitting.LIMIT).alias("n_over"), F.count_if(wrong).alias("n_wrong"))


def _passages(spark, d):
    return language.passages(read(spark, d, "extract_input"), read(spark, d, "lang_samples"))


def p6_found(spark, d):
    return language.mislabelled(_passages(spark, d))


def p6_passages(spark, d):
    return _passages(spark, d)


def p7_found(spark, d):
    return p7_containers(spark, d).where("pieces > 1").select("doc_id").distinct()


def p7_containers(spark, d):
    return packing.pack(read(spark, d, "documents"), read(spark, d, "token_pieces"))


def p7_tokens(spark, d):
    """Tokens of each document, summed over its pieces."""
    return p7_containers(spark, d).groupBy("doc_id").agg(F.sum("n_tokens").alias("n_tokens"))


def p7_fill(spark, d):
    """All tokens by containers, containers over the capacity or whose fill is not the sum of their pieces, and whether 95 % of their room
    is used, but for one container."""
    c = p7_containers(spark, d).groupBy("container").agg(F.max("fill").alias("fill"), F.sum("n_tokens").alias("tokens"))
    wrong = F.count_if((F.col("fill") != F.col("tokens")) | (F.col("fill") > packing.CAPACITY))
    return c.agg(F.sum("tokens").alias("n_tokens"), wrong.alias("n_wrong"), (F.count(F.lit(1)) <= F.sum("tokens") / (0.95 * packing.CAPACITY) + 1).alias("tight"))


def p8_found(spark, d):
    return p8_leaks(spark, d).select("doc_id", "item_id").distinct()


def p8_leaks(spark, d):
    return leakage.leaks(read(spark, d, "documents"), read(spark, d, "eval_items"))


def _clean(spark, d):
    return personal.clean_lines(read(spark, d, "lang_samples"))


def p9_found(spark, d):
    return personal.find(read(spark, d, "documents"), _clean(spark, d)).select("doc_id", "kind", "start_pos").distinct()


def p9_redacted(spark, d):
    return personal.redact(read(spark, d, "documents"), _clean(spark, d))


def queries():
    return {k: f for k, f in globals().items() if k[0] == "p" and k[1].isdigit()}
