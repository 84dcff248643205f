"""Captures of pages without ids."""

from turnloom.llm import warc


def test_null_ids_keep_a_row_each(spark):
    pages = [(None, "u", "x"), (None, "u", "x"), (1, "v", "y"), (None, "w", "y"), (None, None, None), (2, "v", ""), (2, "v", "")]
    frame = spark.createDataFrame(pages, "page_id long, url string, html string").repartition(2)
    got = sorted(((r.page_id, r.payload_bytes, r.record_type, r.refers_to) for r in warc.round_trip(frame).collect()), key=str)
    want = [(None, 1, "response", None)] * 2 + [(1, 1, "response", None), (None, 1, "revisit", 1), (None, 0, "revisit", 2)] + [(2, 0, "response", None)] * 2
    assert got == sorted(want, key=str)


def test_rows_in_any_order_give_the_same_files(spark, tmp_path):
    pages = [(i // 3, f"u{i % 4}", f"<p>{i % 7}</p>") for i in range(60)] + [(None, "u", "<p>0</p>"), (None, None, None)]
    written = []
    for turn, order in enumerate((pages, pages[::-1])):
        folder = tmp_path / f"a{turn}"
        frame = spark.createDataFrame(order, "page_id long, url string, html string").repartition(3, "url")
        warc.write(frame, str(folder)).collect()
        written.append({f.name: f.read_bytes() for f in folder.iterdir()})
    assert written[0] == written[1] and written[0]


def test_publish_where_a_name_is_taken(tmp_path):
    """A file system that refuses to move onto a file keeps the first attempt's."""
    import pyarrow.fs as pafs

    from turnloom.llm.common import publish

    class Strict:
        def __init__(self):
            self.fs = pafs.LocalFileSystem()

        def __getattr__(self, name):
            return getattr(self.fs, name)

        def move(self, a, b):
            if self.fs.get_file_info(b).type == pafs.FileType.File:
                raise FileExistsError(b)
            self.fs.move(a, b)

    for attempt in (1, 2):
        assert publish(Strict(), str(tmp_path), "x", attempt, iter([b"ab", b"c"])) == 3
    assert [f.name for f in tmp_path.iterdir()] == ["x"] and (tmp_path / "x").read_bytes() == b"abc"
