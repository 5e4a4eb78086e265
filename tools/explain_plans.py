"""Write PLANS.md: physical plan trees of the headline operators.

    python tools/explain_plans.py [sf_dir]

Two settings: the local defaults, and the cluster shape where no side of a
data-sized join is small enough to broadcast (both broadcast thresholds
off).  Only the operator tree of ``explain("formatted")`` is kept.
"""

from __future__ import annotations

import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

from cardlens.operators import marts as MT  # noqa: E402
from cardlens.operators import quality as QC  # noqa: E402
from cardlens.plans.stages import stages  # noqa: E402
from cardlens.schemas import AMOUNT, KEY  # noqa: E402
from cardlens.session import build_session  # noqa: E402

BROADCAST_KEYS = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]


def tree(df) -> str:
    """The operator tree of the executed (adaptive, final) plan."""
    qe = df._jdf.queryExecution()
    qe.toRdd().count()                       # run this very plan, so AQE finalises it
    text = qe.executedPlan().toString().split("+- == Initial Plan ==")[0]
    lines = [ln.rstrip() for ln in text.splitlines()]
    return "\n".join(ln[:160] for ln in lines)


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session()
    out = ["# Physical plans", "",
           f"Generated by `tools/explain_plans.py` on `{sf}` (local[8]). Each plan is the final",
           "adaptive plan after the query ran; long lines are cut at 160 characters.", ""]
    for label, off in [("local defaults", False), ("cluster shape: broadcast thresholds off", True)]:
        for k in BROADCAST_KEYS:
            if off:
                spark.conf.set(k, "-1")
            else:
                spark.conf.unset(k)
        s = stages(spark, sf)
        cases = {
            "features (merge -> clean -> per-card statistics -> salted join back)": s.staging,
            "fraud_summary (mart, unordered)": MT.fraud_summary(s.narrow, ordered=False),
            "fraud_hourly (mart with shares)": MT.fraud_hourly(s.narrow),
            "quality suite (16 checks, one aggregate)": QC.run_checks(s.staging, QC.staging_suite()),
            "uniqueness tests of the staging table and its view (one shuffle)": QC.schema_tests({
                "staging_fraud": (s.staging.select(KEY, AMOUNT), [QC.Check("unique", KEY)]),
                "stg_fraud": (QC.View("staging_fraud", MT.has_value(AMOUNT), {"transaction_id": KEY}),
                              [QC.Check("unique", "transaction_id")])}),
        }
        out += [f"## {label}", ""]
        for name, df in cases.items():
            out += [f"### {name}", "", "```", tree(df), "```", ""]
    (ROOT / "PLANS.md").write_text("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main()
