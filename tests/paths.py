"""Where the tests find the benchmark tables (a module of its own: two folders have a conftest)."""

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"
