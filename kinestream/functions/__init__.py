"""Column functions: vectors, rotations, cameras, kinematics."""
