"""Rotations, poses and projection as column expressions, unrolled so that they stay in generated code.

A rotation is an array of 9 doubles by rows, a vector one of 3, a quaternion x, y, z, w."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def vector(*parts) -> Column:
    return F.array(*(p.cast("double") if isinstance(p, Column) else F.lit(float(p)) for p in parts))


def matrix(values) -> Column:
    """A constant rotation."""
    return vector(*values)


def rotation(q: Column) -> Column:
    """The rotation of a quaternion, which need not have length one."""
    x, y, z, w = (q[k] for k in range(4))
    n = x * x + y * y + z * z + w * w
    s = F.try_divide(F.lit(2.0), n)
    return F.array(
        1 - s * (y * y + z * z), s * (x * y - z * w), s * (x * z + y * w), s * (x * y + z * w), 1 - s * (x * x + z * z), s * (y * z - x * w),
        s * (x * z - y * w), s * (y * z + x * w), 1 - s * (x * x + y * y),
    )


def quaternion(r: Column) -> Column:
    """The quaternion of a rotation by its largest component; the sign is such that w >= 0."""
    m = [r[k] for k in range(9)]
    squares = [1 + m[0] - m[4] - m[8], 1 - m[0] + m[4] - m[8], 1 - m[0] - m[4] + m[8], 1 + m[0] + m[4] + m[8]]  # 4x², 4y², 4z², 4w²
    xy, xz, yz, xw, yw, zw = m[1] + m[3], m[2] + m[6], m[5] + m[7], m[7] - m[5], m[2] - m[6], m[3] - m[1]
    rows = [(squares[0], xy, xz, xw), (xy, squares[1], yz, yw), (xz, yz, squares[2], zw), (xw, yw, zw, squares[3])]
    top = F.greatest(*squares)
    pick = None
    for square, row in reversed(list(zip(squares, rows))):
        half = 2 * F.sqrt(square)
        q = F.array(*(v / half for v in row))
        pick = q if pick is None else F.when(square == top, q).otherwise(pick)
    return F.transform(pick, lambda v: v * F.when(pick[3] < 0, -1.0).otherwise(1.0))


def turned(r: Column, t: Column) -> Column:
    """Rotation times vector."""
    return F.array(*(r[3 * i] * t[0] + r[3 * i + 1] * t[1] + r[3 * i + 2] * t[2] for i in range(3)))


def product(a: Column, b: Column) -> Column:
    """Rotation times rotation."""
    return F.array(*(a[3 * i] * b[j] + a[3 * i + 1] * b[3 + j] + a[3 * i + 2] * b[6 + j] for i in range(3) for j in range(3)))


def plus(a: Column, b: Column) -> Column:
    return F.array(*(a[k] + b[k] for k in range(3)))


def chained(r_wb, p_wb, r_cw, p_cw) -> tuple[Column, Column]:
    """Base to camera from constants, base to world and world to camera; composed here once, not on every row."""
    r = [sum(r_cw[3 * i + k] * r_wb[3 * k + j] for k in range(3)) for i in range(3) for j in range(3)]
    p = [sum(r_cw[3 * i + k] * p_wb[k] for k in range(3)) + p_cw[i] for i in range(3)]
    return vector(*r), vector(*p)


def measured_pose(r_local: Column, t_local: Column, r_cb: Column, p_cb: Column) -> tuple[Column, Column]:
    """Tool tip in the camera, from its pose in the base and the base's in the camera: one product a rotation. Where the
    base's pose differs by row, base_in_camera() gives it; select it first, so that it is a column by itself."""
    return product(r_cb, r_local), plus(turned(r_cb, t_local), p_cb)


def base_in_camera(r_wb: Column, p_wb: Column, r_cw: Column, p_cw: Column) -> tuple[Column, Column]:
    """chained() for columns."""
    return product(r_cw, r_wb), plus(turned(r_cw, p_wb), p_cw)


def setpoint_pose(r_set: Column, t_set: Column, r_cw: Column, p_cw: Column) -> tuple[Column, Column]:
    """Only the camera's transform, for setpoints that are in the world already; null where the setpoint is."""
    there = r_set.isNotNull() & t_set.isNotNull()
    return F.when(there, product(r_cw, r_set)), F.when(there, plus(turned(r_cw, t_set), p_cw))


def inverse(r: Column, t: Column) -> tuple[Column, Column]:
    """Inverse of a rigid transform."""
    back = F.array(*(r[3 * j + i] for i in range(3) for j in range(3)))
    moved = turned(back, t)
    return back, F.array(*(-moved[k] for k in range(3)))


def offset_pose(r: Column, t: Column, offset: Column | None) -> tuple[Column, Column]:
    """Pose times a 4x4 offset (16 values by rows, null for none); another number of values raises."""
    identity = F.array(*(F.lit(float(k % 5 == 0)) for k in range(16)))
    m = identity if offset is None else F.coalesce(offset, identity)
    m = F.when(F.size(m) != 16, F.raise_error(F.lit("an offset has 16 values")).cast("array<double>")).otherwise(m)
    return product(r, F.array(*(m[4 * i + j] for i in range(3) for j in range(3)))), plus(turned(r, F.array(m[3], m[7], m[11])), t)


def predicted(t: Column, w: Column, v: Column, frequency: Column) -> Column:
    """First-order position after 1 / frequency seconds at linear velocity v and angular velocity w about the origin."""
    cross = [w[1] * t[2] - w[2] * t[1], w[2] * t[0] - w[0] * t[2], w[0] * t[1] - w[1] * t[0]]
    dt = F.try_divide(F.lit(1.0), frequency)
    return F.array(*(t[k] + (v[k] + cross[k]) * dt for k in range(3)))


def projected(p: Column, fx: float, fy: float, cx: float, cy: float, baseline: float = 0.0) -> tuple[Column, Column]:
    """Pixel of a point in camera coordinates, without distortion; null behind the camera. baseline shifts the point for
    the right camera. Depths under 1e-9 count as 1e-9."""
    z = F.greatest(p[2], F.lit(1e-9))
    ahead = p[2] > 0
    return F.when(ahead, fx * (p[0] - baseline) / z + cx), F.when(ahead, fy * p[1] / z + cy)


def outside(u: Column, v: Column, width: float, height: float) -> Column:
    """Whether a pixel lies outside [0, width) x [0, height); null pixels do."""
    return ~F.coalesce((u >= 0) & (u < width) & (v >= 0) & (v < height), F.lit(False))


def depth(disparity: Column, fx: float, baseline: float, eps: float = 1e-6) -> Column:
    """Depths of an array of disparities as floats; NaN for NaN and for eps or less."""
    return F.transform(disparity, lambda x: F.when(F.isnan(x) | (x <= eps), F.lit(float("nan"))).otherwise(baseline * fx / x.cast("double")).cast("float"))


def depth_weight(p: Column, advanced: bool, tolerance: float = 0.02) -> Column:
    """Weight of the predicted point by its distance from the camera."""
    s = F.sqrt(p[0] * p[0] + p[1] * p[1] + p[2] * p[2]) - tolerance
    return F.exp((-s + F.exp(-s)) / 2) if advanced else 1 / (1000 * F.greatest(s, F.lit(4e-4)))


def polar(x: Column, y: Column) -> tuple[Column, Column]:
    """Length and angle in [0, 2 pi) of a flow vector."""
    angle = F.atan2(y, x)
    return F.hypot(x, y), F.when(angle < 0, angle + F.lit(2.0) * F.pi()).otherwise(angle)
