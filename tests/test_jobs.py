import uuid

from pyspark.sql import functions as F

from papertriage import jobs
from papertriage.functions.text import normalize_text
from papertriage.operators import encode as EN
from papertriage.operators import papers as PP
from papertriage.operators import score as SC
from papertriage.plans.encode_queries import HASH_CFG, encoded_papers
from papertriage.session import scratch_path
from papertriage.sources import outputs as OUT
from papertriage.sources.notes import notes_from_documents

SF = "/root/testdata/sf0.001"


def collapsed_related(spark, refs):
    """Related rows for references collapsed by a plain dict (first id and
    title, last abstract per normalised title), as the job must do."""
    by_title = {}
    for r in refs.withColumn("key", normalize_text("title")).orderBy("ref_id").collect():
        first = by_title.setdefault(r["key"], [r["ref_id"], r["title"], None])
        first[2] = r["abstract"]
    assert len(by_title) < refs.count()  # the table has such references
    rows = spark.createDataFrame([tuple(v) for v in by_title.values()], "ref_id long, title string, abstract string")
    ref_set = SC.collect_reference_set(EN.embed_papers(rows, None, 32), "ref_id", "embedding")
    return SC.related_only(SC.score_papers(encoded_papers(spark, SF), ref_set, HASH_CFG))


def test_triage_job_matches_query(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    papers, _ = PP.split_usable(PP.papers_from_documents(docs, "https://papers.example.org/paper/"))
    refs = papers.filter(F.col("paper_id") < 23).select(F.col("paper_id").alias("ref_id"), "title", "abstract")
    root = scratch_path(spark, f"job-{uuid.uuid4().hex}")
    paths = jobs.triage_job(spark, docs.select(F.col("doc_id").alias("paper_id"), "text").join(
        papers.select("paper_id", "title", "abstract", "url"), "paper_id").drop("text"), refs, root, HASH_CFG)
    want = collapsed_related(spark, refs)
    assert set(paths) == {"scored", "related", "related_detailed", "rejects", "report", "summary"}
    assert paths["summary"]["n_related"] == want.count()
    related = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(paths["related"])
    assert related.count() == want.count()
    report = spark.read.parquet(paths["report"])
    assert sorted(r[0] for r in report.select("paper_id").collect()) == sorted(r[0] for r in want.select("paper_id").collect())
    detailed = spark.read.json(paths["related_detailed"])
    assert detailed.count() == want.count()


def test_triage_job_has_no_reference_limit(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    papers, _ = PP.split_usable(PP.papers_from_documents(docs, "https://papers.example.org/paper/"))
    papers = papers.select("paper_id", "title", "abstract", "url").filter("paper_id < 60")
    refs = papers.filter(F.col("paper_id") < 23).select(F.col("paper_id").alias("ref_id"), "title", "abstract")
    out = []
    for cfg in (HASH_CFG, HASH_CFG.with_(max_reference_bytes=100)):
        paths = jobs.triage_job(spark, papers, refs, scratch_path(spark, f"job-{uuid.uuid4().hex}"), cfg, exclude_ref_titles=True)
        schema = "title string, abstract string, mean_abstract_similarity double, detailed_similarities map<string,double>"
        detailed = [(r[0], round(r[2], 9), [(k, round(v, 9)) for k, v in r[3].items()]) for r in spark.read.schema(schema).json(paths["related_detailed"]).collect()]
        report = sorted(tuple(r) for r in spark.read.parquet(paths["report"]).collect())
        out.append((paths["summary"], sorted(detailed), report))
    assert out[0] == out[1] and out[0][0]["n_related"] > 0


def test_output_tables_appear_together(spark):
    root = scratch_path(spark, f"publish-{uuid.uuid4().hex}")
    assert OUT.published(spark, root) == {}
    first = OUT.Publication(spark, root)
    first.write({"scored": spark.range(3).toDF("n")})
    first.write({"related": spark.range(2).toDF("n")})
    assert OUT.published(spark, root) == {}
    first.commit()
    killed = OUT.Publication(spark, root)  # ends before its second table
    killed.write({"scored": spark.range(9).toDF("n")})
    paths = OUT.published(spark, root)
    assert {k: spark.read.parquet(v).count() for k, v in paths.items()} == {"scored": 3, "related": 2}
    second = OUT.Publication(spark, root)
    second.write({"scored": spark.range(5).toDF("n"), "related": spark.range(1).toDF("n")})
    second.commit()
    assert {k: spark.read.parquet(v).count() for k, v in OUT.published(spark, root).items()} == {"scored": 5, "related": 1}


def test_notes_job(spark):
    notes = notes_from_documents(spark.read.parquet(f"{SF}/documents.parquet"))
    accepted, rejects = jobs.notes_job(notes)
    assert accepted.columns == ["title", "abstract", "url"]
    assert accepted.count() + rejects.count() <= notes.count()
    assert rejects.count() == notes.filter(F.col("content.venue.value").isNull()).count()


def test_pages_job(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    listing = pages.select("url").union(pages.select(F.concat("url", F.lit("-missing")).alias("url")))
    papers, rejects = jobs.pages_job(listing, pages)
    n = pages.count()
    assert papers.count() + rejects.count() == 2 * n
    assert rejects.filter(F.col("reason") == "page not stored").count() == n
