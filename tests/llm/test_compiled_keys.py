"""The probe hashes of op2 run in methods that the JVM compiles, with the same rows."""

import contextlib
import io
import re

from pyspark.sql import functions as F

from sparkpipe.llm import linededup
from sparkpipe.llm.common import materialise, prepare


LIMIT = "spark.sql.codegen.hugeMethodLimit"


def test_probe_hashes_are_compiled(spark, monkeypatch):
    texts = ["From the first line to the last one\nshort é\n", "From the first line to the last ones\nshort e\n\n", None]
    docs = prepare(spark).createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    lines = linededup.lines_of(docs).withColumn("chars", F.char_length("line"))
    hashed = lines.select(F.when(F.col("chars") >= 30, F.array(*(k for k, _, _ in linededup.probe_keys(2)))))
    shown = io.StringIO()
    with contextlib.redirect_stdout(shown):
        hashed.explain("codegen")
    assert max(int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", shown.getvalue())) > 8000

    limits, before = {}, spark.conf.get(LIMIT)

    def noted(df, name):
        limits[name] = int(spark.conf.get(LIMIT))
        return materialise(df, name)

    monkeypatch.setattr(linededup, "materialise", noted)
    split = sorted(map(str, linededup.line_report(docs).collect()))
    assert limits["line-classes"] <= 8000 and spark.conf.get(LIMIT) == before
    monkeypatch.setattr(linededup, "compiled_methods", lambda spark: contextlib.nullcontext())
    assert split == sorted(map(str, linededup.line_report(docs).collect())) and len(split) == 4
