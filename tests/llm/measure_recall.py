"""Recall of op 9 on N vectors without clusters: ``python tests/llm/measure_recall.py [N]``.

130,000 vectors make 1,015 lists. Prints one JSON line.
"""

import json
import sys
import time
from pathlib import Path

import numpy as np
import pandas as pd
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

from volspark.llm import neighbours  # noqa: E402


def main(n: int) -> None:
    spark = SparkSession.builder.master("local[8]").config("spark.driver.memory", "6g").getOrCreate()
    spark.conf.set("spark.sql.execution.arrow.pyspark.enabled", "true")
    data = np.random.default_rng(0).normal(size=(n, 64)).astype(np.float32)
    rows = spark.createDataFrame(pd.DataFrame({"vec_id": np.arange(n), "embedding": list(data)})).repartition(32)
    began, got = time.time(), {}
    for r in neighbours.search(rows, "id % 50 = 0").collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    took, own, hits = time.time() - began, neighbours.unit(data).astype(np.float32), 0
    for q in range(0, n, 50):
        scores = own @ own[q]
        scores[q] = -2
        hits += len(got.get(q, set()) & set(np.argpartition(-scores, 5)[:5].tolist()))
    lists = max(1, min(min(n, neighbours.SAMPLE) // 4, n // neighbours.LIST_LENGTH, neighbours.MOST_CENTROIDS))
    print(json.dumps({"vectors": n, "lists": lists, "recall": round(hits / (5 * len(range(0, n, 50))), 4), "seconds": round(took, 1)}))


if __name__ == "__main__":
    main(int(sys.argv[1]) if len(sys.argv) > 1 else 130_000)
