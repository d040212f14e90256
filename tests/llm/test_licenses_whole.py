"""Every template is found, on one line and wrapped as a comment."""

import textwrap

from lakelink.llm import licenses


def test_wrapped_and_unwrapped(spark):
    rows, want = [], {}
    for k, (name, text) in enumerate(licenses.TEMPLATES):
        for style, mark, width in ((0, "", 500), (1, "# ", 60), (2, " * ", 40), (3, "// ", 30)):
            body = "\n".join(mark + x for x in textwrap.wrap(text, width))
            i = 10 * k + style
            rows.append((i, f"d{i}/a.py", f"import numpy\n\n{body}\n\nx = 1\nfor y in range(10): print(y)"))
            want[i] = name
    d = spark.createDataFrame(rows, "file_id long, path string, text string")
    got = {r.file_id: (r.own_license, r.own_score) for r in licenses.scan(d).collect()}
    assert {i: x for i, (x, _) in got.items()} == want and min(s for _, s in got.values()) > 0.99
