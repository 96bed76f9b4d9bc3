from quarrylight.sources import files


def test_files(spark, tmp_path):
    (tmp_path / "a.txt").write_bytes(b"\xef\xbb\xbf hi\r\nyou \n")
    (tmp_path / "b.md").write_bytes(b"\xff\xfe\x00")
    (tmp_path / "c.jsonl").write_text('# note\n\n{"id": "x", "n": 1}\n')
    got = {r.name: (r.text, r.valid) for r in files.texts(spark, str(tmp_path)).collect()}
    assert got == {"a.txt": ("hi\nyou", True), "b.md": (None, False)}
    assert [tuple(r) for r in files.json_lines(spark, str(tmp_path / "c.jsonl"), "id string, n int").collect()] == [("x", 1)]
