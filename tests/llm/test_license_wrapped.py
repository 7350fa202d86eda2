from hourglass.llm import license_scan as S

BSD = ("/* Redistribution and use in source and binary forms, with or without\n"
       " * modification, are permitted provided that the following conditions are met */")


def test_notices_wrapped_over_lines(spark):
    texts = {BSD: "bsd", "x\n# Licensed under the Apache License,\n# Version 2.0 (the License)\ny": "apache-2.0",
             "Released\nunder\nthe\nMIT\nlicense": "mit", BSD.replace("\n", "\r\n"): "bsd",
             "Licensed under the Apache License,\n\nVersion 2.0": "",       # two paragraphs
             "Licensed under the Apache License,\n *\n * Version 2.0": "",  # a line without words, too
             "version 2 0\nlicensed under the apache": "",                  # another order
             "released under\n" + "x " * 9 + "\nthe mit": ""}               # too far apart
    rows = list(enumerate(texts))
    got = {r.doc_id: (r.labels, r.score) for r in S.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, text in rows:
        want = texts[text]
        assert got[i] == (want, 1.0 if want else 0.0), (text, got[i])
