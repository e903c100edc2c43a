import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from trendlens.session import build_session
    ckpt = str(tmp_path_factory.mktemp("ckpt"))
    s = build_session(master="local[4]", shuffle_partitions=8,
                      extra={"spark.checkpoint.dir": ckpt, "spark.driver.memory": "4g"})
    yield s
    s.stop()


@pytest.fixture
def write_lines(tmp_path):
    def _write(name, lines):
        p = tmp_path / name
        p.write_text("".join(line + "\n" for line in lines))
        return str(p)
    return _write


def record_line(date="20150218230000", names="", rid="20150218230000-0", fields=27):
    """A tab-separated news record with ``fields`` columns."""
    cols = [""] * fields
    cols[0] = rid
    if fields > 1:
        cols[1] = date
    if fields > 23:
        cols[23] = names
    if fields > 24:
        cols[24] = "amount"
    return "\t".join(cols)
