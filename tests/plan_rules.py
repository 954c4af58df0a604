"""Scale rules checked on an executed physical plan."""

import re


def check_plan_rules(name: str, text: str) -> None:
    """- no Cartesian product and no nested-loop join;
    - no window without a partition key, unless its input is a limit's
      bounded output (it would otherwise run in one task);
    - every keyed aggregate appears as a partial and a final step.
    """
    assert "CartesianProduct" not in text, name
    assert "BroadcastNestedLoopJoin" not in text, name
    lines = [l.strip(" +-:*()0123456789") for l in text.splitlines()]
    for i, line in enumerate(lines):
        if line.startswith("Window [") and re.search(r"\], \[\], \[", line):
            below = " ".join(lines[i + 1:i + 4])
            assert "TakeOrderedAndProject" in below or "Limit" in below, (name, line)
    seen = {}
    for m in re.finditer(r"(?:Hash|ObjectHash|Sort)Aggregate\(keys=\[(.*?)\], functions=", text):
        keys = frozenset(re.findall(r"(?<!id=)#(\d+)", m.group(1)))
        if keys:
            seen[keys] = seen.get(keys, 0) + 1
    single = [k for k, n in seen.items() if n < 2]
    assert not single, (name, single)
