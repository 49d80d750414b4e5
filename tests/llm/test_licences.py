"""Licence files as they are found in projects."""

from pathlib import Path

from nearstop.llm import licences

TEXTS = Path(licences.__file__).parent / "licence_texts"


def test_usual_files(spark):
    mit, isc = licences.KNOWN["MIT"][1], licences.KNOWN["ISC"][0]
    apache = (TEXTS / "Apache-2.0.txt").read_text()
    gpl = (TEXTS / "GPL-3.0.txt").read_text()
    bsd = licences.KNOWN["BSD-3-Clause"][0]
    files = [
        (f"MIT License\n\nCopyright (c) 2021 A. Person\n\n{mit}\n", "MIT"),
        (f"The MIT License (MIT)\n\nCopyright © 2021 A. Person\n\n{mit}\n", "MIT"),
        (f"ISC License\n\nCopyright (c) 2020, B\n\n{isc}", "ISC"),
        (apache, "Apache-2.0"),
        (apache.replace("[yyyy] [name of copyright owner]", "2020 Somebody"), "Apache-2.0"),
        (apache[:apache.index("APPENDIX: How")], "Apache-2.0"),
        (gpl, "GPL-3.0"),
        (gpl[:gpl.index("How to Apply")], "GPL-3.0"),
        (f"BSD 3-Clause License\n\nCopyright (c) 2020, B\nAll rights reserved.\n\n{bsd}",
         "BSD-3-Clause"),
        (f"Copyright 2020 B\n\n{licences.KNOWN['BSD-2-Clause'][0]}", "BSD-2-Clause"),
        (licences.KNOWN["Unlicense"][0], "Unlicense"),
        (licences.KNOWN["Zlib"][0], "Zlib"),
        ((TEXTS / "LGPL-2.1.txt").read_text(), "LGPL-2.1"),
        ((TEXTS / "MPL-2.0.txt").read_text(), "MPL-2.0"),
        (f"MIT License\n\n{mit} Not for sale.", None),
    ]
    docs = spark.createDataFrame(
        [(n, text) for n, (text, _) in enumerate(files)], "doc_id long, text string"
    )
    rows = licences.scan_licences(docs, licences.known_licences(spark)).collect()
    assert {r.doc_id: r.licence for r in rows} == {n: name for n, (_, name) in enumerate(files)}
