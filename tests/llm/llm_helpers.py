"""What the tests of the operators share."""

SF_DIR = "/root/testdata/sf0.001"
