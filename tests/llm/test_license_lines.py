"""Notices on odd lines and whole licences, against the SQL."""

from pathlib import Path

import pytest
from oracle import same

from corpusmill.llm.license_texts import DIGESTS, LICENSES
from corpusmill.llm.licenses import ORACLE, license_scan
from corpusmill.llm.queries import op1_license_scan

LINES = ["/" * 200 + " Released under the MIT License. " + "/" * 200, "Licensed under" + " " * 300 + "CC BY 4.0.", "-" * 160 + "\nThis work is dedicated to the public domain." + "*" * 160, "license " * 100, "dedicated to the public-domain", "This work is dedicated to the public-domain.", "This work is dedicated to the public  domain."]


def test_padded_notices(spark, tmp_path):
    docs = spark.createDataFrame(list(enumerate(LINES)), "doc_id long, text string")
    docs.coalesce(1).toPandas().to_parquet(tmp_path / "documents.parquet")
    found = {r.doc_id: r.notices for r in op1_license_scan(spark, str(tmp_path)).collect()}
    assert [found[k] for k in range(4)] == ["MIT", "CC-BY-4.0", "CC0-1.0", ""]
    same(spark, op1_license_scan, ORACLE, str(tmp_path))


#: Where a Debian machine has whole licences.
SHARED = Path("/usr/share/common-licenses")


@pytest.mark.skipif(not SHARED.is_dir(), reason="no licence texts on this machine")
def test_whole_licenses(spark, tmp_path):
    """Published texts as they are, in upper case with other line ends, and with a word more."""
    files = {"Apache-2.0": "Apache-2.0", "CC0-1.0": "CC0-1.0", "GPL-2": "GPL-2.0-only", "GPL-3": "GPL-3.0-only", "LGPL-2.1": "LGPL-2.1-only", "LGPL-3": "LGPL-3.0-only", "MPL-2.0": "MPL-2.0"}
    texts = [(SHARED / f).read_text() for f in files]
    rows = [*texts, *(t.upper().replace("\n", "\r\n   ") for t in texts), *(t + " more" for t in texts), None]
    spark.createDataFrame([(k, t) for k, t in enumerate(rows)], "doc_id long, text string").toPandas().to_parquet(tmp_path / "documents.parquet")
    found = {r.doc_id: r.license_id for r in op1_license_scan(spark, str(tmp_path)).collect()}
    assert [found[k] for k in range(22)] == [*files.values(), *files.values(), *[None] * 8]
    same(spark, op1_license_scan, ORACLE, str(tmp_path))


def test_repeated_rows(spark):
    text = dict(LICENSES)["BSL-1.0"]
    df = spark.createDataFrame([(1, text, "x"), (1, text, "x"), (None, text, "y"), (2, None, "z")], "doc_id long, text string, license_id string")
    assert sorted((r.doc_id or 0, r.license_id or "") for r in license_scan(df).collect()) == [(0, "BSL-1.0"), (1, "BSL-1.0"), (1, "BSL-1.0"), (2, "")]
    assert len(dict(DIGESTS)) == len(DIGESTS)
