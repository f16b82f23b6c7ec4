"""CIGARs parsed once per distinct string, against the column expressions; slices of unspliced reads are dealt over tasks."""

import random

from pyspark.sql import functions as F

from locuslens.functions import cigars, dna
from locuslens.operators import realign

ODD = [None, "", "*", "96M", "8S88M", "88M8S", "30M2D5M1I60M", "5H3S40M3N20M2P4=1X6S", "10I", "12D", "3S", "20M5I", "7H20M", "M", "40M0D56M", "20M300N30M4H", "30M66S", "66S30M"]


def test_parsed_strings_equal_the_expressions(spark):
    r = random.Random(61)
    some = ["".join(f"{r.randint(1, 99)}{r.choice('MIDNSHP=X')}" for _ in range(r.randint(1, 6))) for _ in range(200)]
    c, clip = F.col("c"), dna.CLIP_OPS
    core = F.regexp_replace(F.regexp_replace(c, f"^[0-9]+[{clip}]", ""), f"[0-9]+[{clip}]$", "")
    event = F.regexp_replace(F.regexp_replace(core, "^[0-9]+M", ""), "[0-9]+M$", "")
    one = dna.op_count(event) == 1
    kind = F.when(dna.op_count(core) > 1, F.when(one & event.endswith("I"), "I").when(one & event.rlike("[DN]$"), "D").otherwise("C"))
    want = {
        "clips": {"left_clip": dna.left_clip(c), "right_clip": dna.right_clip(c)},
        "part": {"s_span": dna.op_total(c, "MDN"), "s_left": dna.left_clip(c, clip), "s_right": dna.right_clip(c, clip), "s_query": dna.op_total(c, "MI"), "s_lead": dna.first_length(c, "^([0-9]+)M"), "s_tail": dna.first_length(c, "([0-9]+)M$")},
        "event": {"span": dna.op_total(c, "MDN"), "q_from": dna.left_clip(c, clip), "p_query": dna.op_total(core, "MI"), "lead": dna.first_length(core, "^([0-9]+)M"), "is_event": dna.op_count(core) > 1, "kind": kind, "e_all": dna.op_total(event, "MIDNSHP=X"), "e_query_total": dna.op_total(event, "MI")},
    }
    rows = spark.createDataFrame([(x,) for x in ODD + some], "c string").withColumns({name: getattr(cigars, name)("c") for name in want})
    pairs = [F.col(name)[f].eqNullSafe(e).alias(f) for name, fields in want.items() for f, e in fields.items()]
    assert [(x.c, [k for k, same in x.asDict().items() if same is False]) for x in rows.select("c", *pairs).collect() if False in x] == []


def test_first_supplementary_entry(spark):
    tags = [None, "", ";", "chr1,5,+,30M66S,30,0;", "chr2,6,-,66S30M,5,1;chrY,500,+,30M66S,3,0;", ";chr3,7,+,9M,1,2"]
    rows = spark.createDataFrame([(t,) for t in tags], "sa string").withColumn("parts", F.split(dna.first_supplementary(F.col("sa")), ","))
    got = rows.select(dna.supplementary_fields(F.col("parts")).alias("s"), F.get(dna.supplementary(F.col("sa")), F.lit(0)).alias("t")).collect()
    assert [x.s for x in got] == [x.t for x in got] and [x.s is None for x in got] == [True, True, True, False, False, False]


def test_reads_to_align_are_dealt_where_partition_counts_agree(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", 4 * spark.sparkContext.defaultParallelism)
    try:
        r = random.Random(62)
        rows = spark.createDataFrame([("".join(r.choices("ACGT", k=12)), "ACGTAC") for _ in range(60)], "slice string, seq string")
        assert realign.realigned(rows).select(F.spark_partition_id().alias("p")).distinct().count() > 4
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
