from tessel.functions.predicates import (  # noqa: F401
    all_finite,
    cross,
    distance,
    finite_point,
    lex_less,
    normalized_rect,
    not_nan,
    point_in_rect,
    point_on_border,
    rect_contains,
    rect_endpoint_overlap,
    rect_intersects,
    squared_distance,
    valid_rect,
)
