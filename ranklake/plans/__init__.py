"""The jobs: each is a plan built from operators, and a runner that reads and writes its tables."""
