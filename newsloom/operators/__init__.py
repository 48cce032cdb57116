"""newsloom.operators"""
