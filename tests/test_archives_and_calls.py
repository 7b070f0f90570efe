"""ZIP members as a data source (S1, S2), and analyzer calls in a bounded window."""

import io
import os
import random
import threading
import time
import zipfile

import pytest

from folioforge.operators import analyzer as A
from folioforge.sources import archives as AR
from folioforge.sources import zip_source as Z

NAMES = ["a.pdf", "d/b.JPG", "d/", "__MACOSX/c.pdf", "x/._d.pdf", ".e.pdf", "~f.png", "g.txt", "h.pdf.exe", "d/.hidden/i.pdf", "noext",
         "é ñ.jpeg", "d//j.png", ".pdf", "k."]


def build(path, entries, how=zipfile.ZIP_DEFLATED):
    with zipfile.ZipFile(path, "w", how) as zf:
        for name, data in entries:
            zf.writestr(name, data)


def damage(path, name, to):
    """Overwrite bytes of a member's data (its local header and the directory stay)."""
    with zipfile.ZipFile(path) as zf:
        info = zf.getinfo(name)
    with open(path, "r+b") as f:
        f.seek(info.header_offset + 30 + len(name.encode()))
        f.write(to)


def flag(path, name, offset, value):
    """Set a field of a member's entry in the central directory."""
    data = bytearray(open(path, "rb").read())
    at = data.rfind(name.encode()) - 46
    assert data[at:at + 4] == b"PK\x01\x02"
    data[at + offset:at + offset + 2] = value.to_bytes(2, "little")
    with open(path, "wb") as f:
        f.write(data)


@pytest.fixture()
def folder(tmpdir_):
    rng = random.Random(1)
    at = f"{tmpdir_}/zips"
    os.makedirs(f"{at}/sub")
    build(f"{at}/big.zip", [(f"m{i:03d}.pdf", rng.randbytes(20_000)) for i in range(60)], zipfile.ZIP_STORED)
    build(f"{at}/sub/names.zip", [(n, b"" if n.endswith("/") else n.encode()) for n in NAMES])
    build(f"{at}/empty.zip", [])
    with open(f"{at}/bad.zip", "wb") as f:
        f.write(b"not a zip" * 50_000)
    open(f"{at}/zero.zip", "wb").close()
    build(f"{at}/broken.zip", [("ok.pdf", b"x" * 500), ("deflate.pdf", rng.randbytes(500)), ("locked.pdf", b"y" * 50), ("odd.pdf", b"z" * 50)])
    damage(f"{at}/broken.zip", "deflate.pdf", b"\xff" * 40)
    flag(f"{at}/broken.zip", "locked.pdf", 8, 1)    # encrypted
    flag(f"{at}/broken.zip", "odd.pdf", 10, 97)     # unknown compression
    return at


def told(df):
    return sorted((os.path.basename(r.archive), r.ord, r.member or "", r.size, None if r.content is None else bytes(r.content),
                   (r.error or "").split(":")[0]) for r in df.collect())


def test_a_large_archive_is_read_by_several_tasks(spark, folder):
    df = Z.read_members(spark, folder, slice_bytes=100_000, batch_bytes=50_000)
    assert df.where("archive LIKE '%big.zip'").selectExpr("spark_partition_id() AS p").distinct().count() >= 10
    rows = told(df)
    with zipfile.ZipFile(f"{folder}/big.zip") as zf:
        want = [("big.zip", k, i.filename, i.file_size, zf.read(i), "") for k, i in enumerate(zf.infolist())]
    assert [r for r in rows if r[0] == "big.zip"] == want
    # the same as the binaryFile form, archive by archive, errors included
    plain = AR.archive_members(spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.zip").load(folder))
    assert [r for r in rows if r[0] != "zero.zip"] == told(plain)  # binaryFile skips empty files


def test_broken_members_are_rejects_not_failures(spark, folder):
    rows = {r[2]: r for r in told(Z.read_members(spark, folder)) if r[0] == "broken.zip"}
    assert rows["ok.pdf"][4] == b"x" * 500 and rows["ok.pdf"][5] == ""
    assert all(rows[n][4] is None and rows[n][5] == "unreadable member" for n in ("deflate.pdf", "locked.pdf", "odd.pdf"))
    corrupt = [r for r in told(Z.read_members(spark, folder, slice_bytes=50_000)) if r[1] == -1]
    assert [(r[0], r[5]) for r in corrupt] == [("bad.zip", "corrupt archive"), ("zero.zip", "corrupt archive")]  # once, not once a slice


@pytest.mark.parametrize("how", ["name", "path"])
def test_pushed_filter_equals_the_flags(spark, folder, how):
    every = AR.member_flags(Z.read_members(spark, folder))
    want = every.where(("keep" if how == "name" else "keep_path") + " OR ord = -1")
    assert told(Z.read_members(spark, folder, how)) == told(want)
    assert all(Z.wanted(r.member, how) for r in want.where("ord >= 0").collect())
    with pytest.raises(Exception, match="unknown member_filter"):
        spark.read.format("zip_members").option("path", folder).option("member_filter", "x").load().count()


def test_dropped_members_are_not_unpacked(folder):
    path = f"{folder}/broken.zip"
    rows = list(Z.members_of("a", open(path, "rb"), how="name"))
    assert len(rows) == 4
    flag(path, "locked.pdf", 8, 0)
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as zf:
        zf.writestr("skip.txt", b"a" * 100)
    seen = []
    real = zipfile.ZipFile.read
    try:
        zipfile.ZipFile.read = lambda self, info, *a: seen.append(info.filename) or real(self, info, *a)
        assert list(Z.members_of("a", buf, how="name")) == [] and seen == []
    finally:
        zipfile.ZipFile.read = real


def test_batches_are_bounded():
    rows = [("a", i, "m", n, b"x" * n, None) for i, n in enumerate([10, 10, 50, 5, 5, 5, 30, 1])]
    got = list(Z.in_batches(iter(rows), 20))
    assert [[r[3] for r in b] for b in got] == [[10, 10], [50], [5, 5, 5], [30], [1]]


def test_window_keeps_order_and_bound():
    rng, lock, running, most, drawn = random.Random(2), threading.Lock(), [0], [0], []

    def call(job):
        with lock:
            running[0] += 1
            most[0] = max(most[0], running[0])
        time.sleep(rng.random() / 50)
        with lock:
            running[0] -= 1
        if job % 7 == 3:
            raise ValueError(job)
        return job * 10

    def jobs():
        for i in range(40):
            drawn.append(i)
            yield i
    got, ahead = [], 0
    for job, done in A.in_order(jobs(), call, 4):
        ahead = max(ahead, len(drawn) - len(got))
        got.append((job, done.result() if done.exception() is None else "error"))
    assert got == [(i, "error" if i % 7 == 3 else i * 10) for i in range(40)]
    assert 1 < most[0] <= 4 and ahead <= 5


PAGES = "lot_id int, batch_no long, pos int, alias string, text string"


def test_calls_per_batch_with_statuses(spark, tmpdir_):
    rng = random.Random(5)
    rows = [(lot, b, p, f"page_{p:03d}.pdf", f"{lot}/{b}") for lot in range(4) for b in range(3) for p in range(1, rng.randint(2, 15))]
    rng.shuffle(rows)
    pages = spark.createDataFrame(rows, PAGES)
    log = f"{tmpdir_}/calls"
    os.makedirs(log)

    def call(batch):
        import os as _os
        import time as _time

        from folioforge.operators.analyzer import Exhausted
        lot, b = int(batch["lot_id"].iloc[0]), int(batch["batch_no"].iloc[0])
        open(_os.path.join(log, f"{lot}-{b}-{_time.time_ns()}"), "w").close()
        _time.sleep(0.02 * ((lot * 3 + b) % 4))
        assert list(batch["pos"]) == sorted(batch["pos"])
        if (lot, b) == (2, 1):
            raise Exhausted("quota")
        if (lot, b) == (1, 0):
            raise RuntimeError("odd answer")
        if (lot, b) == (0, 2):
            return []
        return [{"folios": [f"A{lot}{b}"], "pages": list(batch["alias"]), "document_type": "Factura", "client_name": None,
                 "confidence_score": 90, "reasoning": "r"}] * 2
    results = []
    for in_flight, tasks in ((1, 1), (3, 1), (4, 5)):
        docs, statuses = A.call_analyzer(pages, ["lot_id", "batch_no"], call, in_flight=in_flight, tasks=tasks)
        status = {(r.lot_id, r.batch_no): r.status for r in statuses.collect()}
        assert len(status) == 12 and status[1, 0] == "failed" and status[0, 2] == "ok" and status[2, 1] == "exhausted"
        gated = A.gate_failed_lots(docs.unionByName(statuses.select("lot_id", "batch_no", "status"), allowMissingColumns=True))
        results.append(sorted((r.lot_id, r.batch_no, r.doc_idx, r.folios, r.pages) for r in gated.where("doc_idx IS NOT NULL").collect()))
        docs.count()
    assert results[0] == results[1] == results[2] and {r[0] for r in results[0]} == {0, 1}
    assert len({f.rsplit("-", 1)[0] for f in os.listdir(log)}) <= 12 and len(os.listdir(log)) <= 36  # answers are read, not asked again


def test_calls_in_the_audit(spark):
    from folioforge.plans.end_to_end import audit_from_files
    files = spark.createDataFrame([(f"{c}.pdf", None, 60) for c in "abc"], "file_name string, mtime timestamp, n_pages int")
    texts = spark.createDataFrame([], "file_name string, page_no int, text string")

    def call(batch):
        from folioforge.operators.analyzer import Exhausted
        if batch["lot_id"].iloc[0] == 2:
            raise Exhausted("quota")
        if batch["lot_id"].iloc[0] == 1:
            raise RuntimeError("no answer")
        return [{"folios": ["A1"], "pages": list(batch["alias"][:2]), "document_type": "Factura", "client_name": "Z",
                 "confidence_score": 90, "reasoning": "r"}]
    audit = audit_from_files(files, texts, lambda pages: A.call_analyzer(pages, ["lot_id", "batch_no"], call))
    items = audit.items.collect()
    regular = [r for r in items if not r.is_orphan]
    assert {(r.lot_id, r.folio) for r in regular} == {(0, "A1"), (1, "ERROR_DOCUMENTO_ILEGIBLE")}
    assert sum(bool(r.is_orphan) for r in items) == 58
    assert sorted(r.file_name for r in audit.files.collect()) == ["a.pdf", "b.pdf"]  # lot 2 is held back
    assert [(r.reason, r.key) for r in audit.rejects.where("stage = 'analyzer'").collect()] == [("failed_batch", "1/1")]
