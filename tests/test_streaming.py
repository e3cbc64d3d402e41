from pyspark.sql import functions as F

from graphspark.plans import kg_testdata as kg
from graphspark.plans import rag
from graphspark.streaming import answer_stream

SF = "/root/testdata/sf0.001"


def test_stream_of_questions_matches_batch(spark, tmp_path):
    graph = kg.stored(spark, SF)
    questions = graph.questions()
    src = tmp_path / "incoming"
    # Questions land as several files, i.e. several arrivals.
    questions.repartition(3).write.parquet(str(src))
    stream = spark.readStream.schema(questions.schema).option("maxFilesPerTrigger", 1) \
        .parquet(str(src))

    def answer(batch):
        return rag.graph_rag(batch, graph.node_vectors, graph.nodes, graph.edges,
                             graph.predicates, cutoff=kg.CUTOFF, recall_k=kg.RECALL_K,
                             max_facts=kg.MAX_FACTS, prefix=kg.PREFIX)

    sink = tmp_path / "answers"
    q = answer_stream(stream, answer, str(sink), checkpoint_location=str(tmp_path / "ckpt"))
    q.awaitTermination(300)
    got = spark.read.parquet(str(sink))
    assert got.select("batch_id").distinct().count() >= 2
    streamed = sorted(tuple(r) for r in got.drop("batch_id").collect())
    batch = sorted(tuple(r) for r in answer(questions).select(*got.drop("batch_id").columns)
                   .collect())
    assert streamed == batch
    assert got.where(F.col("status") == "ok").count() > 0


def test_a_restarted_stream_answers_each_question_once(spark, tmp_path):
    schema = "question_id long, question string"
    for run in range(3):
        spark.createDataFrame([(run, f"q{run}")], schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
        query = answer_stream(stream, lambda batch: batch.withColumn("answer", F.col("question")), str(tmp_path / "out"),
                              checkpoint_location=str(tmp_path / "state"))
        query.awaitTermination(120)
    got = spark.read.parquet(str(tmp_path / "out")).orderBy("question_id").collect()
    assert [r["question_id"] for r in got] == [0, 1, 2]
