"""What the inventory claims."""

import re

from terrane.plans import catalog

#: Out of the engine: external programs, packs and their notices.
OUTSIDE = {"SRC09", "SRC25", "SNK08", "PIP11"}


def test_claims_are_of_the_inventory():
    claimed = {x for ids in catalog.COVERS.values() for x in ids}
    assert all(re.fullmatch(r"(SRC|SNK|FLT|PRJ|GEO|ARR|JN|AGG|SRT|SET|STR|FTS|PIP|MAN|GTE)\d\d|Q\d+", x) for x in claimed)
    assert not claimed & OUTSIDE
