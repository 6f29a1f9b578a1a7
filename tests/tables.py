"""Small literal tables used by the tests."""

from __future__ import annotations

from faultline.spec import MACHINE_READINGS as SPEC


def machine_rows(n=100, positives_from=81, step=8):
    """n readings; failures from ``positives_from`` on, with higher torque."""
    rows = []
    for i in range(1, n + 1):
        y = int(i >= positives_from)
        kind = "LMH"[i % 3]
        rows.append(
            (
                i, f"{kind}{i:05d}", kind,
                298 + 0.01 * i, 308 + 0.01 * i, 1400.0 + i, 40 + step * y + 0.01 * i, float(i % 200),
                y, y, 0, 0, 0, 0,
            )
        )
    return rows


THREE = [
    (1, "M14860", "M", 298.1, 308.6, 1551.0, 42.8, 0.0, 0, 0, 0, 0, 0, 0),
    (2, "L47181", "L", 299.0, 309.2, 1408.0, 46.3, 3.0, 0, 0, 0, 0, 0, 0),
    (3, "H29424", "H", 300.0, 310.0, 1300.0, 50.0, 10.0, 1, 1, 0, 0, 0, 0),
]
TORQUE, TYPE, TARGET = 6, 2, 8


def changed(rows, **by_position):
    """Copies of rows with single cells replaced: changed(rows, r0c6=None)."""
    out = [list(r) for r in rows]
    for place, value in by_position.items():
        r, c = place[1:].split("c")
        out[int(r)][int(c)] = value
    return [tuple(r) for r in out]


def machine_table(spark, rows):
    return spark.createDataFrame(rows, SPEC.schema())


def scored(spark, labels, probabilities):
    rows = [(i, y, p) for i, (y, p) in enumerate(zip(labels, probabilities, strict=True))]
    return spark.createDataFrame(rows, "key bigint, label int, probability double")


def threshold_rows(spark, *rows):
    """Full threshold rows from (threshold, tn, fp, fn, tp) with costs 10 and 1."""
    out = []
    for t, tn, fp, fn, tp in rows:
        n = tn + fp + fn + tp
        precision = tp / (tp + fp) if tp + fp else 0.0
        recall = tp / (tp + fn) if tp + fn else 0.0
        f1 = 2 * tp / (2 * tp + fp + fn) if 2 * tp + fp + fn else 0.0
        out.append(
            (t, (tn + tp) / n, precision, recall, f1, tn, fp, fn, tp, fp + tp, (fp + tp) / n, 10.0 * fn + fp)
        )
    return spark.createDataFrame(
        out,
        "threshold double, accuracy double, precision double, recall double, f1 double,"
        " true_negative bigint, false_positive bigint, false_negative bigint, true_positive bigint,"
        " predicted_positive_count bigint, predicted_positive_rate double, total_cost double",
    )


def rows_of(df, *columns):
    return [tuple(r[c] for c in columns) for r in df.collect()]


def one(df):
    rows = df.collect()
    assert len(rows) == 1, rows
    return rows[0].asDict()
