"""Writes binary dumps for the tests."""

import io
import json
import tarfile
import zipfile

import numpy as np


def block(layout, start, end, step, matrix):
    """layout: [(resource, [element], [metric])], written key by key so that keys can repeat."""
    groups = ",".join(f'"{r}":{json.dumps({"IDs": [str(i) for i in range(len(e))], "Names": e, "DataTypes": [int(x) for x in m]})}' for r, e, m in layout)
    head = ('{"StartTime":"%d","EndTime":"%d","Archive":"%d","CtrlID":"0A","Map":{%s}}' % (start, end, step, groups)).encode()
    return np.array([0, 8 + len(head)], "<i4").tobytes() + head + np.asarray(matrix, "<i4").tobytes()


def dump(blocks, sn="SN1"):
    return b"\1" * 32 + b"\0" * 4 + sn.encode().ljust(256, b"\0") + b"dump".ljust(41, b"\0") + b"\0" * 4 + b"".join(blocks)


def tgz(*members):
    out = io.BytesIO()
    with tarfile.open(fileobj=out, mode="w:gz") as t:
        for i, raw in enumerate(members):
            info = tarfile.TarInfo(f"m{i}.dat")
            info.size = len(raw)
            t.addfile(info, io.BytesIO(raw))
    return out.getvalue()


def zipped(members):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for name, raw in members.items():
            z.writestr(name, raw)
    return out.getvalue()
