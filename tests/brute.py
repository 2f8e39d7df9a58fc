"""Independent, byte-at-a-time statements of the semantics (test oracles)."""

from __future__ import annotations


def align(data: bytes, p: int) -> int:
    """Start of the first line after skipping to byte p-1 (reference reader rule)."""
    n = len(data)
    if p <= 0:
        return 0
    if p >= n:
        return n
    j = p - 1
    while j < n:
        c = data[j]
        if c == 0x0A:
            return j + 1
        if c == 0x0D:
            return j + 2 if j + 1 < n and data[j + 1] == 0x0A else j + 1
        j += 1
    return n


def lines(data: bytes) -> list[bytes]:
    out, start, j, n = [], 0, 0, len(data)
    while j < n:
        c = data[j]
        if c == 0x0A or c == 0x0D:
            end = j + 2 if c == 0x0D and j + 1 < n and data[j + 1] == 0x0A else j + 1
            out.append(data[start:end])
            start = j = end
            continue
        j += 1
    if start < n:
        out.append(data[start:])
    return out


def chunks(data: bytes, unit: int, header: int = 0):
    n_bytes = len(data)
    if n_bytes == 0:
        return []
    n = (n_bytes - 1) // unit + 1
    hend = 0
    if header:
        ls = lines(data)
        for ln in ls[:header]:
            if ln.endswith(b"\n") or ln.endswith(b"\r"):
                hend += len(ln)
            else:
                break
    out = []
    for i in range(n):
        s, e = align(data, n_bytes * i // n), align(data, n_bytes * (i + 1) // n)
        if header:
            s = max(hend, s) if i > 0 else s
            e = max(hend, e)
        if e > s:
            body = data[s:e]
            if header and i > 0:
                body = data[:hend] + body
            out.append((i, s, e, body.decode("utf-8")))
    return out


def greedy_pack(sizes: list[int], m: int) -> list[int]:
    tasks, cur, acc, open_ = [], 0, 0, False
    for s in sizes:
        if open_ and acc >= m:
            cur += 1
            acc = 0
        acc += s
        open_ = True
        tasks.append(cur)
    return tasks
