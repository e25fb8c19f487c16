"""Naming an intermediate value inside an expression, as SQL text."""


def let(name: str, value: str, body: str) -> str:
    """`body` with `name` standing for `value`, which is evaluated once.

    A column that a lambda reads from the projection below may be merged *into* the lambda by the
    optimizer and then be evaluated once per array element. A lambda parameter is not.
    """
    return f"get(transform(array({value}), {name} -> {body}), 0)"
