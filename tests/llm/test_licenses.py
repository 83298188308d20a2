"""Labels and scores of the licence scan against a plain reading, and its time on a very long text."""

import random
import time

import pyarrow as pa

from shardloom.llm import license_scan as ls
from shardloom.llm import queries as q
from tests.llm import brute

RULES = (ls.BASE, ls.NOTICES, ls.FREEDOM, ls.label_of, ls.UNKNOWN, ls.EXCEPTION)
SF = "/root/testdata/sf0.01"


def test_labels_and_scores_of_a_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = q.op4_license_scan(spark, SF).select("doc_id", "labels", "score").collect()
    want = brute.license_labels(rows, *RULES)
    assert brute.in_order(map(tuple, got)) == brute.in_order(want)
    assert len({r[1] for r in want}) > 1


def test_labels_and_scores_of_made_texts(spark):
    rng = random.Random(5)
    pieces = ["SPDX-License-Identifier: ", "spdx license identifier ", "MIT", "Apache-2.0", "GPL-2.0-or-later", "BSD-3-Clause", " OR ", " and ", " WITH ",
              "(", ")", "Classpath-exception-2.0", "\n", ", ", "under the MIT license", "CC BY-NC", "all rights reserved", "words ", "LGPL-2.1+", "."]
    texts = ["".join(rng.choice(pieces) for _ in range(rng.randrange(1, 14))) for _ in range(3000)]
    odd = [(i, t) for i, t in enumerate([*texts, None, "", "xspdx license identifier MIT", "SPDX-License-Identifier: (MIT"])]
    got = ls.license_scan(spark.createDataFrame(odd, "doc_id long, text string")).select("doc_id", "labels", "score").collect()
    assert brute.in_order(map(tuple, got)) == brute.in_order(brute.license_labels(odd, *RULES))


def test_ten_megabytes_of_hits():
    text, began = "cc by nc " * 1_100_000 + "SPDX-License-Identifier: MIT OR Apache-2.0", time.time()
    found = ls.scan_text(text, ls.automaton())
    assert time.time() - began < 20
    assert found["n_words"] == 3_300_000 + 8 and len(found["places"]) == 1_100_000
    assert found["places"][0] == (0, "cc-by-nc") and found["places"][-1] == (3_299_997, "cc-by-nc")
    assert found["labels"] == {"cc-by-nc", "mit", "apache-2"}
    assert pa.array([w for w, _ in found["places"]]).to_numpy().tolist() == list(range(0, 3_300_000, 3))
