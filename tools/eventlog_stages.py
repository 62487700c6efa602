"""Summarise job and stage durations from a Spark event log folder (zstd or plain)."""

import glob
import io
import json
import sys


def lines(path):
    raw = open(path, "rb").read()
    if path.endswith(".zstd"):
        import zstandard
        raw = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw)).read()
    return raw.decode("utf-8").splitlines()


def main(folder):
    stages, jobs = {}, {}
    files = sorted(glob.glob(f"{folder}/**/events_*", recursive=True)) or sorted(glob.glob(f"{folder}/*"))
    for f in files:
        for line in lines(f):
            e = json.loads(line)
            ev = e["Event"]
            if ev == "SparkListenerStageCompleted":
                si = e["Stage Info"]
                stages[si["Stage ID"]] = (si["Number of Tasks"],
                                          (si.get("Completion Time", 0) - si.get("Submission Time", 0)) / 1000,
                                          si["Stage Name"][:40])
            elif ev == "SparkListenerJobStart":
                jobs[e["Job ID"]] = [e["Submission Time"], e["Stage IDs"]]
            elif ev == "SparkListenerJobEnd" and e["Job ID"] in jobs:
                jobs[e["Job ID"]].append(e["Completion Time"])
    t0 = min(j[0] for j in jobs.values())
    for jid, j in sorted(jobs.items()):
        if len(j) == 3:
            st = [(s, *stages[s]) for s in j[1] if s in stages]
            print(f"job {jid:3d} t={(j[0] - t0) / 1000:6.2f}s dur={(j[2] - j[0]) / 1000:5.2f}s "
                  + " ".join(f"[s{s} {n}t {d:.2f}s]" for s, n, d, _ in st))


if __name__ == "__main__":
    main(sys.argv[1])
