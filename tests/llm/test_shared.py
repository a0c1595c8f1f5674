import threading

from tendril.llm import simhash_dedup, similar_texts, suffix_dedup
from tendril.llm.shared import passing, written


def test_scopes_of_threads_are_apart(spark):
    """What one thread's scope deletes isn't what another wrote meanwhile."""
    inside, go_on, failed = threading.Event(), threading.Event(), []

    def other():
        with passing(spark):
            df = written(spark.range(5).toDF("x"), "other")
            inside.set()
            go_on.wait(60)
            if df.count() != 5:
                failed.append("lost")

    thread = threading.Thread(target=other)
    with passing(spark):
        thread.start()
        inside.wait(60)
        written(spark.range(3).toDF("x"), "own")
    go_on.set()
    thread.join()
    assert not failed


def test_operators_run_at_the_same_time(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    counts, errors = {}, []

    def run(name, operator):
        try:
            counts[name] = operator(spark, "/root/testdata/sf0.001").count() if name != "near" else operator(docs).count()
        except Exception as e:  # noqa: BLE001
            errors.append(e)

    jobs = {"simhash": simhash_dedup.op6_simhash_near_duplicates, "suffix": suffix_dedup.op8_suffix_array_dedup, "near": similar_texts.without_similar}
    threads = [threading.Thread(target=run, args=x) for x in jobs.items()]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert not errors and counts["simhash"] == counts["suffix"] == docs.count() and 0 < counts["near"] < docs.count()
