from pyspark.sql import functions as F

import __spark_entry__ as E
from immolytics.functions.text import normalize_text
from immolytics.operators import model as pm
from immolytics.plans import queries as Q
from immolytics.streaming.scoring import scored_requests, start_scoring_stream

from .conftest import SF_SMALL


def test_scoring_stream_matches_batch(spark, tmp_path):
    enc_s, enc = Q.encoded_split(spark, SF_SMALL)
    feats = Q.BASE_FEATURES + enc.all_feature_names
    model = pm.train_price_model(enc_s.where(F.col("split") == "train"), feats, maxIter=3, maxDepth=3)
    raw = Q.split_prepared(spark, SF_SMALL).where(F.col("split") == "test")
    requests = raw.select("id_transaction", "type_batiment", normalize_text("nom_region").alias("nom_region"),
                          *[c for c in Q.BASE_FEATURES])
    src = str(tmp_path / "requests")
    requests.write.json(src)
    sink = str(tmp_path / "scored")
    q = start_scoring_stream(spark, src, requests.schema, model, enc, feats, sink,
                             passthrough=["id_transaction"], checkpoint=str(tmp_path / "ckpt"), available_now=True)
    q.awaitTermination(300)
    streamed = spark.read.parquet(sink)
    batch = scored_requests(requests, model, enc, feats, ["id_transaction"])
    assert streamed.count() == requests.count() > 0
    diff = (streamed.select("id_transaction", "prediction")
            .join(batch.select("id_transaction", F.col("prediction").alias("p2")), "id_transaction")
            .where(F.abs(F.col("prediction") - F.col("p2")) > 1e-6))
    assert diff.count() == 0
