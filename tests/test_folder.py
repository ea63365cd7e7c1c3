"""The folder source: names, packs, block hashes and files that cannot be read."""

import hashlib

from pagequarry.sources import folder as S


def fill(tmp_path):
    files = {"a.pdf": b"one", "_x.pdf": b"", ".x.pdf": b"dot", "_dir/x.pdf": b"under", "deep/.h/y [1]{2}*.csv": b"c,d\n" * 9, "big.xlsx": b"z" * 5000,
             "UP.PDF": b"up", "note.txt": b"no", "a.pdf.bak": b"no"}
    for name, body in files.items():
        path = tmp_path / "in" / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(body)
    (tmp_path / "in" / "folder.pdf").mkdir()
    return files, str(tmp_path / "in")


def test_every_supported_name_gives_a_hashed_row(spark, tmp_path):
    files, root = fill(tmp_path)
    got = {r.path: r for r in S.scan_folder(spark, root, blockBytes=7, packBytes=10).collect()}
    wanted = {n: b for n, b in files.items() if n.endswith((".pdf", ".csv", ".xlsx"))}
    assert {p.removeprefix(f"file:{root}/"): (r.length, r.hash, r.content, r.error) for p, r in got.items()} == {
        n: (len(b), hashlib.sha256(b).hexdigest(), None, None) for n, b in wanted.items()}
    assert all(abs(r.modificationTime.timestamp() - (tmp_path / "in" / p.removeprefix(f"file:{root}/")).stat().st_mtime) < 1e-3 for p, r in got.items())
    assert S.scan_folder(spark, root, any_case=True).count() == len(wanted) + 1
    assert S.scan_folder(spark, root + "/none").count() == 0


def test_contents_up_to_a_limit(spark, tmp_path):
    files, root = fill(tmp_path)
    scan = S.scan_folder(spark, root, content=True, contentLimit=100, blockBytes=64)
    got = {r.path.removeprefix(f"file:{root}/"): r for r in scan.collect()}
    assert got["big.xlsx"].content is None and got["big.xlsx"].hash == hashlib.sha256(files["big.xlsx"]).hexdigest() and "larger" in got["big.xlsx"].error
    assert all(bytes(r.content) == files[n] and r.error is None for n, r in got.items() if n != "big.xlsx")


def test_packs_follow_sizes(tmp_path, monkeypatch):
    _, root = fill(tmp_path)
    packs = S.FolderReader({"path": root, "packbytes": "40"}).partitions()
    assert all(sum(size for *_, size in p.files) <= 40 or len(p.files) == 1 for p in packs)
    assert [f[0] for p in packs for f in p.files] == sorted(f[0] for p in packs for f in p.files)
    monkeypatch.setattr(S, "PACK_FILES", 1)
    assert all(len(p.files) == 1 for p in S.FolderReader({"path": root}).partitions())


def test_a_vanished_file_is_a_row_with_an_error(spark, tmp_path):
    files, root = fill(tmp_path)
    reader = S.FolderReader({"path": root})
    packs = reader.partitions()
    listed = S.scan_folder(spark, root).select("path", "length").collect()
    (tmp_path / "in" / "a.pdf").unlink()
    rows = {r[0]: r for p in packs for r in reader.read(p)}
    gone = rows[f"file:{root}/a.pdf"]
    assert gone[3] is None and gone[4] is None and "FileNotFoundError" in gone[5] and sum(r[5] is None for r in rows.values()) == len(rows) - 1
    read = {r.path: r for r in S.read_named(spark.createDataFrame(listed), root, pack_bytes=30).collect()}
    assert len(read) == len(rows) and read[f"file:{root}/a.pdf"].content is None and "FileNotFoundError" in read[f"file:{root}/a.pdf"].error
    assert all(bytes(r.content) == files[p.removeprefix(f"file:{root}/")] for p, r in read.items() if r.error is None)


def test_contents_are_handed_on_in_bounded_batches(spark, tmp_path, monkeypatch):
    import pyarrow as pa

    files, root = fill(tmp_path)
    monkeypatch.setattr(S, "FLUSH_BYTES", 4)
    batch = pa.RecordBatch.from_pydict({"path": [f"file:{root}/{n}" for n in files], "length": list(range(len(files)))})
    out = list(S._contents(iter([batch]), root=root, block=3, limit=10_000))
    assert len(out) > 2 and [p for b in out for p in b.column("path").to_pylist()] == batch.column("path").to_pylist()
    assert [c for b in out for c in b.column("content").to_pylist()] == list(files.values())


def test_written_files_read_back(spark, tmp_path):
    rows = spark.createDataFrame([("a b/_x.pdf", b"1"), ("/c.csv", b""), ("a b/#%.csv", "\u00e9".encode())], "file string, content binary")
    root = str(tmp_path / "out dir")
    for _ in range(2):  # written again, a file is replaced
        assert sorted(map(tuple, S.write_named(rows, root).collect())) == [("/c.csv", 0), ("a b/#%.csv", 2), ("a b/_x.pdf", 1)]
    assert {r.path.removeprefix(f"file:{root}/"): bytes(r.content) for r in S.scan_folder(spark, root, content=True).collect()} == {
        "a b/_x.pdf": b"1", "c.csv": b"", "a b/#%.csv": "\u00e9".encode()}


def test_contents_are_handed_on_in_small_parts(tmp_path):
    """A task holds a few megabytes of contents, not all that a batch of names lists."""
    import pyarrow as pa

    from pagequarry.sources import folder

    for i in range(8):
        (tmp_path / f"{i}.pdf").write_bytes(bytes([i]) * (3 << 20))
    names = pa.RecordBatch.from_arrays([pa.array([f"file:{tmp_path}/{i}.pdf" for i in range(8)])], ["path"])
    out = list(folder._contents(iter([names]), str(tmp_path), 1 << 20, 1 << 30))
    assert [bytes(c.as_py())[0] for b in out for c in b.column("content")] == list(range(8))
    assert all(sum(len(c.as_py()) for c in b.column("content")) <= 12 << 20 for b in out)


def test_the_driver_knows_packs_and_no_names(spark, tmp_path):
    """A scan's partitions do not grow with the files: each names the list of its pack, which executors have written."""
    import pickle

    files = {f"d{i % 3}/{'deep/' * (i % 2)}{i:04d}{'x' * 100}.pdf" for i in range(600)}
    for name in files:
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_bytes(b"1")
    (tmp_path / "d0" / "gone.pdf").symlink_to(tmp_path / "nowhere")
    listed = S.list_folder(spark, str(tmp_path), (".pdf",))
    assert {r.path for r in listed.collect()} == {f"{tmp_path}/{n}" for n in files}
    scan = S.scan_folder(spark, str(tmp_path))
    assert {r.path for r in scan.collect()} == {f"file:{tmp_path}/{n}" for n in files}
    packs = S.work_folder(spark, "packs")
    listed.repartition(2).write.parquet(packs)
    parts = S.FolderReader({"path": str(tmp_path), "packs": packs}).partitions()
    assert len(parts) == 2 and len(pickle.dumps(parts)) < 1000 and {f[0] for p in parts for f in p} == {f"{tmp_path}/{n}" for n in files}
