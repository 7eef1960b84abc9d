"""The command line, in process, on reference-shaped raw events."""

import json
import os

from eventmart.__main__ import main
from tests.test_sources import raw_event, write_gz


def test_cli_end_to_end(spark, scratch, capsys):
    raw_dir = scratch("raw")
    os.makedirs(raw_dir, exist_ok=True)
    pr = raw_event(5, "PullRequestEvent", number=7, pull_request={"id": 9, "merged": True})
    events = [raw_event(i, "PushEvent", push_id=100 + i) for i in range(4)] + \
             [raw_event(4, "WatchEvent", action="started"), pr]
    write_gz(f"{raw_dir}/2024-01-15-0.json.gz", [json.dumps(e) for e in events[:3]])
    write_gz(f"{raw_dir}/2024-01-15-1.json.gz", [json.dumps(e) for e in events[3:]] + [""])
    glob = f"{raw_dir}/*.json.gz"

    main(["check-schema", "--input", glob])
    table = scratch("events")
    main(["batch", "--input", glob, "--table", table])
    main(["batch", "--input", glob, "--table", table])        # rerun replaces
    main(["duplicates", "--table", table])

    landing, streamed = scratch("landing"), scratch("streamed")
    main(["replay", "--input", glob, "--dest", landing])
    metrics = os.path.join(scratch("m"), "metrics.json")
    os.makedirs(os.path.dirname(metrics), exist_ok=True)
    main(["stream", "--source", landing, "--table", streamed, "--checkpoint", scratch("ckpt"),
          "--metrics-out", metrics])
    with open(metrics) as fh:
        m = json.load(fh)
    assert (m["input_rows"], m["table_rows_after_run"]) == (6, 6)

    export, raw = scratch("export"), scratch("rawload")
    main(["export", "--table", streamed, "--dest", export])
    main(["load", "--source", export, "--dest", raw])
    wh = scratch("wh")
    main(["models", "--raw", raw, "--warehouse", wh])
    main(["snapshot", "--raw", raw, "--warehouse", wh, "--at", "2024-01-16T00:00:00"])
    out = capsys.readouterr().out
    assert "exported 6 rows" in out and "loaded 6 rows" in out and "snapshot version 0" in out
