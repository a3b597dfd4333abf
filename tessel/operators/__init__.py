from tessel.operators.aggregate import grid_aggregate, spatial_aggregate  # noqa: F401
from tessel.operators.envelope import bounds, distinct_points, envelope  # noqa: F401
from tessel.operators.join import spatial_join, spatial_join_chunks, spatial_join_ordered  # noqa: F401
from tessel.operators.join import spatial_join_pairs, spatial_join_text  # noqa: F401
from tessel.operators.range_query import points_on_border, range_query  # noqa: F401
from tessel.operators.hull import convex_hull  # noqa: F401
from tessel.operators.pairs import closest_pair, farthest_pair  # noqa: F401
from tessel.operators.union import boundary_vertices, count_parts, rectangle_union  # noqa: F401
