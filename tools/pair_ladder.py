"""Pair-generation ladder: blocked candidates, rule pairs, dropped rows and time per fixture and scale; recall
against an exhaustive plain-Python run where that is affordable (``--exhaustive-max`` eligible rows).

    python tools/pair_ladder.py [--sf /root/testdata/sf0.001 ...] [--fixture dirty|narrow]
"""
from __future__ import annotations

import argparse
import itertools
import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", nargs="*", default=["/root/testdata/sf0.001", "/root/testdata/sf0.01",
                                                 "/root/testdata/sf0.1"])
    ap.add_argument("--fixture", default="dirty")
    ap.add_argument("--exhaustive-max", type=int, default=1200)
    a = ap.parse_args()

    from cleanspark.operators import clean as C
    from cleanspark.operators import dedup as DD
    from cleanspark.operators import pairs as PR
    from cleanspark.session import cut_lineage, local_session
    from cleanspark.sources import fixtures as FX
    from tests.test_similarity import ratio, token_set

    spark = local_session(8, shuffle_partitions=16, app="pair-ladder")
    for sf in a.sf:
        raw = FX.dirty_customers(spark, sf) if a.fixture == "dirty" else FX.narrow_customers(spark, sf)
        clean = cut_lineage(C.clean_customers(raw))
        t0 = time.perf_counter()
        t = PR.triples(clean, "customer_id")
        cand = cut_lineage(PR.candidate_pairs(t))
        n_cand = cand.count()
        _, dropped, tp = DD.dedup_rule(clean, "customer_id")
        n_pairs, n_dropped = tp.count(), dropped.count()
        secs = time.perf_counter() - t0
        elig = [r.asDict() for r in PR.eligible(clean).select("customer_id", *PR.COMPARED).collect()]
        rec = None
        if len(elig) <= a.exhaustive_max:
            rows = sorted(elig, key=lambda r: r["customer_id"])
            truth = set()
            for x, y in itertools.combinations(rows, 2):
                s = (token_set(x["name"], y["name"]) + ratio(x["email"], y["email"])
                     + ratio(x["phone"], y["phone"])) / 3
                if s > DD.RULE_THRESHOLD:
                    truth.add(y["customer_id"])
            got = {r["customer_id"] for r in dropped.collect()}
            rec = round(len(got & truth) / max(len(truth), 1), 4)
        print(json.dumps({"fixture": a.fixture, "sf": os.path.basename(sf), "rows": clean.count(),
                          "eligible": len(elig), "triples": t.count(), "candidates": n_cand,
                          "rule_triple_pairs": n_pairs, "dropped_rows": n_dropped, "seconds": round(secs, 2),
                          "dropped_recall_vs_exhaustive": rec}), flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
