from tessel.sources.sinks import (  # noqa: F401
    id_lines,
    join_lines,
    pair_lines,
    point_lines,
    write_lines,
    write_parquet,
)
from tessel.sources.tables import FIXTURE_SQL, FIXTURES, fixture  # noqa: F401
from tessel.sources.text import (  # noqa: F401
    parse_lines,
    read_points,
    read_rectangles,
    read_window,
    rejected_lines,
)
