"""Generated landing folders with the edge cases of every fixture set."""

from __future__ import annotations

import gzip
import io
import json
import os
import zlib
from pathlib import Path


def gz_bytes(text: str) -> bytes:
    buf = io.BytesIO()
    with gzip.GzipFile(fileobj=buf, mode="wb", mtime=0) as f:
        f.write(text.encode("utf-8"))
    return buf.getvalue()


def write_gz(path: Path, lines: list[str]) -> Path:
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(gz_bytes("".join(line + "\n" for line in lines)))
    return path


def event(name=None, site="s1", event_id="e1", server_ts=1451606399500, **extra) -> str:
    obj = {"siteId": site, "eventId": event_id, "serverTs": server_ts}
    if name is not None:
        obj["name"] = name
    obj.update(extra)
    return json.dumps(obj)


# One line of each kind the readers must agree on.
VALID = event("zoom", meta={"locations": ["a", "b"], "pseudoEvents": ["p"],
                            "ua": {"groups": ["g1", "g2"]}})
BLANK = ""
MALFORMED = '{"name": "broken", '
MISSING_NAME = event(None, site="s2", event_id="e2")
WRONG_TYPE = event("badzoom", event_id="e3", zoomLevel="big")
OTHER_CASE = event("case", event_id="e4", meta={"pseudoevents": ["q"], "locations": ["x"]})
EDGE_LINES = [VALID, BLANK, MALFORMED, MISSING_NAME, WRONG_TYPE, OTHER_CASE]


def make_clean_root(base: Path) -> Path:
    """``<base>/nom/clean`` with edge-case lines and path shapes."""
    root = base / "nom" / "clean"
    write_gz(root / "2016-08-15.gz", EDGE_LINES)
    write_gz(root / "day 2.gz", [event("zoom", event_id="e5"), event("tts", event_id="e6")])
    write_gz(root / "a+b.gz", [event("zoom", event_id="e7")])
    write_gz(root / "V2" / "clean" / "z.gz", [event("pan", event_id="e8")])
    return root


def make_raw_root(base: Path) -> Path:
    """``<base>/raw/metrics``: the raw envelope, one file the clean side lacks."""
    root = base / "raw" / "metrics"

    def raw(name, **kw):
        return json.dumps({"clientData": {"name": name}, **kw})

    write_gz(root / "2016-08-15.gz", [raw("zoom"), raw("zoom"), raw("tts"), raw(None), "", "{bad"])
    write_gz(root / "day 2.gz", [raw("zoom"), raw("tts")])
    write_gz(root / "only-raw.gz", [raw("pan")])
    return root


def gzip_cases(root: Path) -> dict[str, bool]:
    """Archives of every validity kind; returns file name -> expected isValid."""
    root.mkdir(parents=True, exist_ok=True)
    ok = gz_bytes('{"a":1}\n{"a":2}\n')
    cases = {
        "ok.gz": (ok, True),
        "multi.gz": (ok + gz_bytes('{"a":3}\n'), True),
        "padded.gz": (ok + b"\x00" * 64, True),
        "truncated.gz": (ok[: len(ok) // 2], False),
        "nocrc.gz": (ok[:-8], False),
        "badcrc.gz": (ok[:-8] + (zlib.crc32(b"x") & 0xFFFFFFFF).to_bytes(4, "little") + ok[-4:], False),
        "trailing.gz": (ok + b"garbage", False),
        "header.gz": (ok[:10], False),
        "plain.gz": (b'{"a":1}\n', False),
        "empty.gz": (b"", False),
        "partial-tmp.gz": (ok, None),  # skipped: still being written
    }
    for name, (data, _) in cases.items():
        (root / name).write_bytes(data)
    (root / "notes.txt").write_text("not an archive\n")
    return {n: v for n, (_, v) in cases.items()}


def file_uri(p: Path | str) -> str:
    return "file:" + os.path.abspath(str(p))
