"""keelson.plans"""
