from tablefit.llm import licenses

SF = "/root/testdata/sf0.01"


def path_of(source, i):
    parts = [source or "unknown", str(i // 1000)] + ([str(i // 100)] if i % 10 else [])
    return "/".join(parts)


def test_inheritance_on_the_given_tables(spark):
    """Rows inherit, each from the nearest directory above it that has a licence file."""
    docs = {r.doc_id: r.source for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "source").collect()}
    rows = {r.doc_id: r for r in licenses.query_files(spark, SF).collect()}
    given = {}
    for i, r in sorted(rows.items()):
        if r.origin == "notice" and i % 10 == 0:
            at = path_of(docs[i], i)
            given[at] = min(given.get(at, (1, "")), (-r.score, r.license))
    want = {}
    for i, r in rows.items():
        if r.origin != "notice":
            up = path_of(docs[i], i).split("/")
            near = next((given["/".join(up[:n])] for n in range(len(up), 0, -1) if "/".join(up[:n]) in given), None)
            want[i] = (near[1], "inherited", -near[0]) if near else (None, "none", None)
    assert set(rows) == set(docs) and any(v[1] == "inherited" for v in want.values())
    assert {i: tuple(rows[i])[1:] for i in want} == want
