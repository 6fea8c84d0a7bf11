"""What the pipeline operators bring to the driver has a bound that does not grow with the documents."""

import re
from pathlib import Path

import sitegrain.llm

# Collects by module, with what bounds them.
COLLECTS = {
    "licenses.py": 1,  # a number for each word of the templates
    "packing.py": 2,  # source names and totals, QUEUES at most
    "pii.py": 2,  # two classes; 101 score bins for each of two generators
    "secret_scan.py": 1,  # 2 x 94 x 94 transitions
    "trie.py": 1,  # splitters: fewer than shards, each cut at SPLITTER_TURNS
    "toxicity.py": 1,  # weights, 2 ** BITS at most
}


def test_collects_are_the_bounded_ones():
    for path in Path(sitegrain.llm.__file__).parent.glob("*.py"):
        text = path.read_text()
        n = len(re.findall(r"\.(?:collect|toPandas|toLocalIterator)\(\)", text))
        assert n == COLLECTS.get(path.name, 0), path
        assert "localCheckpoint" not in text and "crossJoin" not in text
