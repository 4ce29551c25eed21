"""Write PLANS.md: the physical-plan shape of every lazy catalogue query and of the plans
inside the fits (one gradient pass, the AUC running sums, the document features).

Usage: python tests/plan_report.py [sf_dir]   (default /root/testdata/sf0.01)
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def formatted(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def tree(text: str) -> str:
    """The operator tree at the top of the formatted plan."""
    lines = []
    for line in text.splitlines()[1:]:
        if not line.strip():
            break
        lines.append(line)
    return "\n".join(lines)


def cached_node_ids(text: str) -> set[str]:
    """Ids of the nodes drawn under an InMemoryRelation: they ran when the cache was filled."""
    ids, depth = set(), None
    for line in tree(text).splitlines():
        indent = len(line) - len(line.lstrip(" :+-|"))
        if depth is not None and indent <= depth:
            depth = None
        if depth is not None:
            ids.update(re.findall(r"\((\d+)\)", line))
        elif "InMemoryRelation" in line:
            depth = indent
    return ids


def facts(text: str) -> dict:
    skip = cached_node_ids(text)
    blocks = re.findall(r"\((\d+)\) (?:Broadcast)?Exchange\n(?:.*\n)*?Arguments: (.*)", text)
    return {
        "exchanges": [re.sub(r", \[plan_id=\d+\]", "", a) for i, a in blocks if i not in skip],
        "scans": re.findall(r"ReadSchema: struct<(.*)>", text),
        "pushed": [p for p in re.findall(r"PushedFilters: \[(.*)\]", text) if p],
    }


def section(name: str, df) -> str:
    text = formatted(df)
    f = facts(text)
    out = [f"### {name}", "", "```", tree(text), "```", ""]
    out.append(
        f"* exchanges run by this plan: {len(f['exchanges'])}" + "".join(f"\n  * `{e}`" for e in f["exchanges"])
    )
    out.append("* scans read: " + ("; ".join(f"`{s}`" for s in f["scans"]) or "none (in-memory)"))
    if f["pushed"]:
        out.append("* pushed filters: " + "; ".join(f"`{p}`" for p in f["pushed"]))
    return "\n".join(out) + "\n"


def main(argv) -> None:
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    from pyspark.sql import functions as F

    from linclass.operators.blocks import packed_blocks
    from linclass.operators.sgd import _gradient_parts
    from linclass.plans import catalogue as C
    from linclass.session import local_session

    spark = local_session(8)
    lazy = [
        "scan_delimited", "label_recode", "drop_columns", "dimensions", "class_profile", "class_counts",
        "data_checks", "set_aside", "hash_split", "random_split", "scaler_fit", "score_logistic_hard",
        "score_logistic_soft", "score_svm", "balanced_accuracy",
    ]
    parts = [
        "# Physical plans",
        "",
        "Generated by `python tests/plan_report.py` (AQE plans before execution, sf0.01 tables).",
        "Fits run eagerly, so their inner plans are shown as built inside them.",
        "",
        "## Catalogue queries",
        "",
    ]
    for name in lazy:
        parts.append(section(name, C.QUERIES[name](spark, sf_dir)))

    parts += ["## Inside the fits", ""]
    parts.append(section("document features joined to labels (input of the document fits)", C.doc_table(spark, sf_dir)))
    train = C.lineitem_folds(spark, sf_dir, C.LOGIT_FEATURES).where(F.col("fold") == "train")
    packed = packed_blocks(train, C.LOGIT_FEATURES, "label")
    parts.append(
        section(
            "one gradient step (the trainer runs it over its cached blocks, in a sibling session "
            "without adaptive execution and with one reducer)",
            _gradient_parts(packed, len(C.LOGIT_FEATURES), [0.1, -1.0, 1.0], 1.0, "logistic"),
        )
    )
    parts.append(section("exact AUC per group (running sums by (group, bucket))", C.q_auc_scores(spark, sf_dir)))
    with open(os.path.join(ROOT, "PLANS.md"), "w") as f:
        f.write("\n".join(parts))
    print("wrote PLANS.md")


if __name__ == "__main__":
    main(sys.argv)
