
from pyspark.sql import functions as F

from papertriage.operators import papers as PP
from papertriage.plans import scoring as SQ

SF = "/root/testdata/sf0.01"


def test_related_is_subset_of_scored_and_plans_agree(spark):
    scored, _ = SQ.scored_papers(spark, SF)
    related = SQ.related_papers(spark, SF)
    jvm = SQ.related_papers_jvm(spark, SF)
    ids = {r[0] for r in related.select("paper_id").collect()}
    assert ids <= {r[0] for r in scored.select("paper_id").collect()}
    assert ids == {r[0] for r in jvm.select("paper_id").collect()}
    assert ids == {r[0] for r in scored.filter("is_related").select("paper_id").collect()}


def test_papers_are_kept_plus_rejects_plus_duplicates(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    papers = PP.papers_from_documents(docs, "u/")
    kept, rejects = PP.split_usable(papers)
    keyed = PP.with_title_key(kept)
    firsts = PP.keep_first_per_key(keyed.select("paper_id", "title_key"), "title_key", "paper_id")
    duplicates = keyed.join(firsts.select("paper_id"), "paper_id", "left_anti")
    assert docs.count() == firsts.count() + duplicates.count() + rejects.count()
    # every duplicate shares its key with a kept first row that has a smaller id
    j = duplicates.select("paper_id", "title_key").join(
        firsts.select(F.col("paper_id").alias("first_id"), "title_key"), "title_key"
    )
    assert j.filter(F.col("first_id") >= F.col("paper_id")).count() == 0
    assert j.count() == duplicates.count()
