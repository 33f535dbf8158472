"""A line of a drop is parsed once, whatever is asked of its columns."""

import re

from fleetpulse.sources import csv_drops

LINE = "date,serial_number,model,smart_5_raw\n"


def test_accepted_lines_are_parsed_once(spark, tmp_path):
    (tmp_path / "a.csv").write_text(LINE + "2024-01-01,S1,\"M,1\",7\nnot a day,S2,M,8\n2024-01-03,,M,9\n2024-01-04,S4\n")
    rows = csv_drops.accepted(csv_drops.read_drops(spark, str(tmp_path)))
    plan = rows._jdf.queryExecution().optimizedPlan().toString().lower()
    assert len(re.findall(r"from_csv\((?:structfield\([^)]*\), )+value#", plan)) == 1
    found = sorted((str(r.date), r.serial_number, r.model, r.smart_5_raw) for r in rows.collect())
    assert found == [("2024-01-01", "S1", "M,1", 7), ("2024-01-04", "S4", None, None)]
