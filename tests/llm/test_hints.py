import os
import re

import fieldcohort.llm as llm

#: Sides that are sent everywhere, and what bounds them.
BOUNDED = {
    "df": "common.small: sent after a count",
    "by_host": "sent after a count of its lines",
    "heads": "sent after a count",
    "kept": "at most about SAMPLE labelled rows",
    "spark.createDataFrame(starts, ...": "one row per partition",
}


def test_hints_stand_only_on_bounded_sides():
    folder = os.path.dirname(llm.__file__)
    found = set()
    for name in sorted(os.listdir(folder)):
        if name.endswith(".py"):
            with open(os.path.join(folder, name), encoding="utf-8") as f:
                found |= {re.sub(r"\(starts, .*", "(starts, ...", m) for m in re.findall(r"F\.broadcast\((\w+(?:\.\w+\(starts, \"[^\"]*\"\))?)\)", f.read())}
    assert found == set(BOUNDED)
