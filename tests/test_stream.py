"""Collection with bounded state: duplicates, late rows, state that falls, restarts."""

import json

from retort.streaming.collect import collect_recent

PAGE = 0


def land(folder, *rows):
    """One page a (smiles, landed) row, in a file of its own."""
    global PAGE
    PAGE += 1
    folder.mkdir(exist_ok=True)
    lines = [json.dumps({"page": i, "landed": t, "molecules": [{"molecule_structures": {"canonical_smiles": s}, "molecule_chembl_id": f"X{PAGE}-{i}"}]}) for i, (s, t) in enumerate(rows)]
    (folder / f"p{PAGE:04}.json").write_text("\n".join(lines) + "\n")


def state_rows(progress):
    return [op["numRowsTotal"] for p in progress for op in (p if isinstance(p, dict) else json.loads(p))["stateOperators"]]


def dropped(progress):
    return sum(op["numRowsDroppedByWatermark"] for p in progress for op in (p if isinstance(p, dict) else json.loads(p))["stateOperators"])


def table(spark, path):
    return sorted((r.smiles, r.landed and r.landed.strftime("%dT%H")) for r in spark.read.parquet(path).collect())


def test_bounded_state(spark, tmp_path):
    landing, sink, late, ckpt = (tmp_path / x for x in ("landing", "sink", "late", "ckpt"))
    run = lambda: collect_recent(spark, str(landing), str(sink), str(late), str(ckpt), delay="2 hours", max_files_per_trigger=1)
    day = "2025-01-0{}T{:02}:00:00.000Z".format
    land(landing, ("C", day(1, 0)), ("CC", day(1, 0)), ("C", day(1, 1)), ("C(", day(1, 1)), ("N", None))
    first = run()
    assert max(state_rows(first)) == 2
    land(landing, ("CC", day(1, 1)), ("CCC", day(1, 2)))
    run()  # a restart on the same checkpoint: CC is still known
    assert table(spark, str(sink)) == [("C", "01T00"), ("CC", "01T00"), ("CCC", "01T02")]
    land(landing, ("O", day(3, 0)))
    run()
    land(landing, ("OO", day(3, 1)))
    progress = run()
    assert state_rows(progress)[-1] <= 2  # what was known on the first day has gone
    land(landing, ("CC", day(1, 3)), ("P", day(1, 0)), ("CC", day(3, 1)), ("OO", day(3, 2)))
    progress = run()
    assert dropped(progress) == 2
    assert table(spark, str(late)) == [("CC", "01T03"), ("N", None), ("P", "01T00")]
    assert table(spark, str(sink)) == [("C", "01T00"), ("CC", "01T00"), ("CC", "03T01"), ("CCC", "01T02"), ("O", "03T00"), ("OO", "03T01")]
    run()  # nothing landed
    assert len(table(spark, str(sink))) == 6 and len(table(spark, str(late))) == 3
