"""Leading eigenpairs of a symmetric matrix that is only known by its products: block Jacobi-Davidson with inner MINRES."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

#: Product of the matrix with the columns of a block.
Product = Callable[[np.ndarray], np.ndarray]
#: Pairs beyond the wanted ones that are followed, so that a wanted one that shows late is not missed; to GUARD_TOL of the largest value.
GUARDS, GUARD_TOL = 4, 1e-7
#: Inner steps of one correction at most, and what it may leave of its right side: few steps need fewest products in all.
INNER, INNER_TOL = 8, 1e-2
#: Outer steps without success before the pairs are refused.
OUTER = 300


def minres(product: Product, right: np.ndarray, tolerance: float = INNER_TOL, steps: int = INNER) -> np.ndarray:
    """For each column b of ``right`` a t that makes |A_b t - b| small, all columns in step: one product a step.

    ``product`` may be another symmetric operator for each column. Every column stops by itself, at ``tolerance`` times |b|, or after ``steps``.
    """
    shape = right.shape
    beta = first = np.linalg.norm(right, axis=0)
    going = first > 0
    v, before = np.divide(right, beta, out=np.zeros(shape), where=going), np.zeros(shape)
    found, dir_1, dir_2 = np.zeros(shape), np.zeros(shape), np.zeros(shape)
    cosine, sine, left, bar, eps = -np.ones_like(beta), np.zeros_like(beta), first.copy(), np.zeros_like(beta), np.zeros_like(beta)
    beta = np.zeros_like(beta)
    for _ in range(steps):
        if not going.any():
            break
        y = product(v) - beta * before
        alpha = np.einsum("ij,ij->j", v, y)
        y -= alpha * v
        after = np.linalg.norm(y, axis=0)
        old, delta, gbar = eps, cosine * bar + sine * alpha, sine * bar - cosine * alpha
        eps, bar = sine * after, -cosine * after
        gamma = np.maximum(np.hypot(gbar, after), np.finfo(float).tiny)
        cosine, sine = gbar / gamma, after / gamma
        new = (v - old * dir_1 - delta * dir_2) / gamma
        found += np.where(going, cosine * left, 0.0) * new
        left = sine * left
        dir_1, dir_2 = dir_2, new
        going &= (left > tolerance * first) & (after > 1e-14 * np.abs(alpha))
        before, v = v, np.divide(y, after, out=np.zeros(shape), where=going)
        beta = after
    return found


def _joined(basis: np.ndarray, fixed: np.ndarray, new: np.ndarray) -> np.ndarray:
    """An orthonormal basis of what ``new`` adds to ``basis`` and ``fixed``."""
    size = np.linalg.norm(new, axis=0)
    new = new[:, size > 0] / size[size > 0]
    for _ in range(2):
        for old in (fixed, basis):
            new = new - old @ (old.T @ new)
    if not new.shape[1]:
        return new
    u, s, _ = np.linalg.svd(new, full_matrices=False)
    u = u[:, s > 1e-10]
    for old in (fixed, basis):
        u = u - old @ (old.T @ u)
    return np.linalg.qr(u)[0]


def leading(product: Product, size: int, wanted: int, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues, falling, and unit eigenvectors as columns, of a positive semidefinite matrix of ``size`` rows.

    Each outer step takes the Ritz pairs of a subspace. Converged leading ones are locked: they stay as they are and the subspace is kept
    at right angles to them. For the others the correction equation (I - ZZ')(A - theta I)(I - ZZ')t = -r, with Z all locked and followed vectors, is solved by MINRES,
    and the corrections widen the subspace, which is cut back to its best half when it's full. Ends when every residual, worked out anew by a
    product, is at the level of rounding: size * 2**-50 of the largest value.
    """
    wanted = min(wanted, size)
    follow = min(size, wanted + GUARDS)
    room = min(size, 5 * follow)
    basis = np.linalg.qr(np.random.default_rng(seed).normal(size=(size, min(size, 2 * follow))))[0]
    made = product(basis)
    locked, values = np.zeros((size, 0)), np.zeros(0)
    for _ in range(OUTER):
        small = basis.T @ made
        theta, turn = np.linalg.eigh((small + small.T) / 2)
        theta, turn = theta[::-1], turn[:, ::-1]
        basis, made = basis @ turn, made @ turn
        top = max(theta[0] if len(theta) else 0.0, values.max(initial=0.0))
        rough = size * 2.0**-50 * top
        open_pairs = min(follow - len(values), len(theta))
        rest = made[:, :open_pairs] - basis[:, :open_pairs] * theta[:open_pairs]
        errors = np.linalg.norm(rest, axis=0)
        ready = int(np.argmin(np.append(errors <= rough, False)))
        ready = min(ready, wanted - len(values))
        if ready:
            locked, values = np.hstack([locked, basis[:, :ready]]), np.append(values, theta[:ready])
            basis, made, theta = basis[:, ready:], made[:, ready:], theta[ready:]
            open_pairs, rest, errors = open_pairs - ready, rest[:, ready:], errors[ready:]
        if len(values) == wanted:
            if (errors <= max(rough, GUARD_TOL * top)).all() and not (theta[:1] > values.min(initial=np.inf)).any():
                again = product(locked)
                if (np.linalg.norm(again - locked * values, axis=0) <= 4 * rough).all():
                    order = np.argsort(-values, kind="stable")
                    return values[order], locked[:, order]
                values = np.zeros(0)  # the subspace's products have drifted: take them all back in, with products made anew
                basis, made, locked = np.hstack([locked, basis]), np.hstack([again, product(basis)]), np.zeros((size, 0))
                continue
            if (theta[:1] > values.min(initial=np.inf)).any():  # one was missed: it goes before the least
                basis, made = np.hstack([locked, basis]), np.hstack([product(locked), made])
                locked, values = np.zeros((size, 0)), np.zeros(0)
                continue
        todo = errors > (rough if len(values) < wanted else max(rough, GUARD_TOL * top))
        shift = theta[:open_pairs][todo]
        known = np.hstack([locked, basis[:, :open_pairs]])

        def off(x, known=known):
            return x - known @ (known.T @ x)

        def shifted(x, shift=shift):
            return off(product(off(x)) - shift * x)

        new = _joined(basis, locked, minres(shifted, -off(rest[:, todo])))
        if basis.shape[1] + new.shape[1] + len(values) > room:
            keep = max(2 * follow - len(values), open_pairs)
            basis, made = basis[:, :keep], made[:, :keep]
            new = _joined(basis, locked, new)
        if not new.shape[1]:  # the subspace holds all there is
            new = _joined(basis, locked, np.random.default_rng(seed + len(values)).normal(size=(size, follow)))
        if new.shape[1]:
            basis, made = np.hstack([basis, new]), np.hstack([made, product(new)])
    raise RuntimeError("Jacobi-Davidson did not reach double precision")
